"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from placetime.llm import common, jaccard, packing, quality
from placetime.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_names_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
    rel = con.sql(SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted([tuple(r[i] for i in at) for r in rel.fetchall()], key=repr)


def test_pipeline_stages(spark):
    docs = common.table(spark, SF, "documents")
    kept = common.stored(spark, corpus_pipeline.quality_rules(spark, docs, SF), "t1")
    verdict = {r["doc_id"]: r["kept"] for r in quality.query(spark, SF).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in verdict.items() if k} and kept.columns == docs.columns
    single = common.stored(spark, corpus_pipeline.near_duplicates(spark, kept, SF), "t2")
    roots = {r["doc_id"]: r["component_id"] for r in jaccard.join(kept).collect()}
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in roots.items() if i == c} and single.columns == docs.columns
    clean = common.stored(spark, corpus_pipeline.personal_data(spark, single, SF), "t3")
    assert clean.count() == single.count() and clean.columns == docs.columns
    assert not clean.where("text rlike '[a-z]@[a-z]'").count()
    mixed = common.stored(spark, corpus_pipeline.source_mix(spark, clean, SF), "t4")
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}
    packed = corpus_pipeline.sequences(spark, mixed, SF)
    pieces = packing.tokenize(mixed, packing.default_tokenizer())
    assert packed.count() == pieces.count()


def test_pipeline_on_an_empty_table(spark):
    docs = common.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(spark, stage(spark, docs, SF), "empty")
    assert docs.count() == 0


def test_release_removes_scratch_tables(spark):
    path = common.stored(spark, spark.range(3), "gone").inputFiles()[0].rsplit("/", 1)[0]
    common.release(spark)
    import os

    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
