"""Lookups and joins of small aggregated tables back to row data.

The reference aligns pandas indexes; in Spark that is a join.  Row tables
grow with the data, aggregated lookups (one row per category, hour, cluster)
do not.  ``join_small`` broadcasts a lookup only after checking its size
in bytes, and falls back to a shuffle join (with AQE skew splitting) beyond the
bound, so a hot key never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lookups up to this many bytes are broadcast.
MAX_BROADCAST_BYTES = 16 << 20
# Rows of a lookup that may be fetched as literals.
MAX_BROADCAST_ROWS = 100_000


def materialize_small(df: DataFrame) -> DataFrame:
    """Compute an aggregated table once and cut its lineage.

    For small results (one row per category, cell or class) that several
    later steps read: without this, each reference re-runs the scan and the
    shuffle beneath it.  The table is written by ``checkpoint`` to the
    session's shared checkpoint folder, so a lost executor does not lose it.
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, for data that a fit reads many times."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join an aggregated lookup to row data, broadcasting it when it is small.

    The lookup is materialised once and measured: the bytes of its texts, and 16
    for any other value.
    """
    small = materialize_small(small)
    width = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if f.dataType.typeName() == "string" else F.lit(16)
                 for f in small.schema.fields), F.lit(0))
    size = small.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]
    side = F.broadcast(small) if size <= max_bytes else small
    return big.join(side, on, how)


def settle_bounded(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Compute an aggregated table once for several readers.

    Up to ``max_rows`` rows become literal rows of the plan, without a file; a
    larger table is written once (``materialize_small``).
    """
    rows = small.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return materialize_small(small)
    return small.sparkSession.createDataFrame(rows, small.schema)


def join_bounded(big: DataFrame, small: DataFrame, on: str, how: str = "left", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join an aggregated lookup to row data that is read in several passes.

    Up to ``max_rows`` rows are broadcast as literals; a larger lookup is joined
    by a shuffle (with AQE skew splitting).
    """
    rows = small.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return big.join(small, on, how)
    return big.join(F.broadcast(big.sparkSession.createDataFrame(rows, small.schema)), on, how)


def hour_domain(spark: SparkSession, name: str = "hour") -> DataFrame:
    """The 24-row hour domain (fixed size, safe to broadcast)."""
    return spark.range(24).select(F.col("id").cast("int").alias(name))


def complete_domain(counts: DataFrame, domain: DataFrame, key: str | Sequence[str],
                    fill: dict) -> DataFrame:
    """Left-join aggregated values onto a fixed domain and fill the gaps.

    ``counts`` must already be aggregated to at most one row per domain
    value; the planner picks the join by their sizes.
    """
    return domain.join(counts, key, "left").na.fill(fill)
