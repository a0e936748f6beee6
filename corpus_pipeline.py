"""A corpus pipeline from five operators of ``placetime.llm``.

Each stage takes (spark, docs, sf_dir), works on what the one before it kept,
and is written as Parquet and read again before the next.  All but the last
return the columns of documents.  The mix may take a document twice, and each
copy is packed; the last stage returns the packed pieces with their token ids.
A stage begins by deleting what earlier ones have worked with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placetime.llm import common, jaccard, mixing, packing, pii, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the rules learned from the labels keep."""
    common.begin_stage(spark, 1, docs)
    return quality.keep_good(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, that of smallest id, of each group of linked texts."""
    common.begin_stage(spark, 2, docs)
    return jaccard.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    common.begin_stage(spark, 3, docs)
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents at the rates that bring sources to their targets."""
    common.begin_stage(spark, 4, docs)
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences."""
    common.begin_stage(spark, 5, docs)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", sequences),
]

#: Learned rules and a tokenizer stand between the tables and the rows, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(spark, stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
