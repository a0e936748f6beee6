"""Incremental hourly counts over a stream of incident files.

Cleaning is a narrow projection, so it runs per micro-batch; the count per
hour is a streaming aggregate whose state is at most 24 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.clean import coerce_incidents
from ..roles import ColumnRoles


def hourly_counts_stream(stream: DataFrame, roles: ColumnRoles, category_filter=None) -> DataFrame:
    """Running (hour, n) counts of a streaming incident DataFrame."""
    rows = coerce_incidents(stream, roles)
    if category_filter is not None:
        rows = rows.where(F.col(roles.category).isin(list(category_filter)))
    return rows.groupBy(roles.hour).agg(F.count(F.lit(1)).alias("n"))


def start_hourly_counts(spark: SparkSession, path: str, schema: StructType | str, roles: ColumnRoles,
                        checkpoint: str, sink: str = "memory", name: str = "hourly_counts",
                        fmt: str = "parquet") -> StreamingQuery:
    """Start the query on a folder of files; state and offsets live in
    ``checkpoint`` (shared storage), so a restarted driver resumes."""
    stream = spark.readStream.schema(schema).format(fmt).load(path)
    counts = hourly_counts_stream(stream, roles)
    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if sink == "memory":
        writer = writer.format("memory").queryName(name)
    else:
        writer = writer.format(sink)
    return writer.start()
