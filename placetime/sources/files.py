"""File sources and sinks.

Everything stays distributed: no ``toPandas``; sinks are Spark writers, so a
100 TB export is written by the executors in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..roles import NA_TOKENS


def read_raw_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV scan.  Pass a schema in production: inference costs a full
    extra pass over the files."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn missing-value tokens (``NA``, ``nan``, empty, ...) in string
    columns into nulls.  Only whole fields count: `` NA `` with blanks is text."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    toks = list(tokens)
    exprs = [
        F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in names
        else F.col(c)
        for c in df.columns
    ]
    return df.select(*exprs)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast each string column to ``long`` or ``double`` if all its values allow it.

    One aggregate over all columns; a column without values stays text.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return df
    kinds = ("long", "double")
    row = df.agg(*[F.coalesce(F.bool_and(F.when(F.col(c).isNotNull(), F.col(c).try_cast(k).isNotNull())), F.lit(False))
                     .alias(f"{i}_{k}") for i, c in enumerate(names) for k in kinds]).first()
    to = {c: next((k for k in kinds if row[f"{i}_{k}"]), None) for i, c in enumerate(names)}
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in to.items() if k})


def read_csv_na(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV scan where the missing-value tokens become null.

    With a declared schema, numeric fields holding tokens are already null
    (PERMISSIVE mode); the string columns are cleaned here.  Without one the
    types are inferred after the tokens are gone, at the cost of a pass.
    """
    if schema is None:
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
        return infer_types(null_tokens(raw))
    return null_tokens(read_raw_csv(spark, path, schema))


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """Processed-table load.  Parquet keeps predicate pushdown and pruning."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_raw_csv(spark, path, schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None,
                partition_by: Sequence[str] | None = None) -> None:
    """Projected sink (all columns when ``columns`` is empty)."""
    out = df.select(*columns) if columns else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # Keep leading/trailing spaces: the CSV writer trims them by default.
        writer.option("header", True).option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        writer.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Summary export: a handful of rows, so one file is fine."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
