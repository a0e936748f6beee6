"""Category x hour matrices: long counts, wide pivot, row-normalised heatmap.

The long form is the scalable one (one grouped aggregate).  The wide form
passes the 24 hour values explicitly, so Spark does not run a job to
discover them and the schema is stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sort import with_position

N = "n"


def pivot_long(df: DataFrame, category: str, hour: str, name: str = N) -> DataFrame:
    """(category, hour, n) for every cell with at least one row."""
    return df.groupBy(category, hour).agg(F.count(F.lit(1)).alias(name))


def pivot_wide(df: DataFrame, category: str, hour: str, hours=range(24), prefix: str = "h") -> DataFrame:
    """One row per category, one count column per hour (zeros filled)."""
    vals = [int(h) for h in hours]
    wide = df.groupBy(category).pivot(hour, vals).agg(F.count(F.lit(1)))
    return wide.select(category, *[F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(f"{prefix}{h}") for h in vals])


def heatmap_normalized(df: DataFrame, category: str, hour: str, value: str = "value",
                       order: str = "row_order") -> DataFrame:
    """Counts divided by the category's row maximum, long form.

    Columns are the hours present in the frame (as in a pandas pivot table);
    rows are ordered by category total (descending, then name).  One scan:
    the (category, hour) counts are materialised once (at most categories x
    24 rows); the present-hour list, row maxima, totals and zero cells all
    come from that small table, and each category's cells are completed by
    exploding the present-hour list (never by joining row data).
    """
    from .joins import materialize_small

    cells = materialize_small(pivot_long(df.where(F.col(hour).isNotNull()), category, hour))
    present = cells.select(F.sort_array(F.collect_set(F.col(hour)))).scalar()
    per_cat = cells.groupBy(category).agg(
        F.sum(N).alias("_total"), F.max(N).alias("_max"),
        F.map_from_entries(F.collect_list(F.struct(F.col(hour), F.col(N)))).alias("_cells"))
    per_cat = with_position(per_cat, [F.col("_total").desc(), F.col(category).asc()], order)
    dense = per_cat.select(category, order, "_max", "_cells", F.explode(present).alias(hour))
    n = F.coalesce(F.element_at(F.col("_cells"), F.col(hour)), F.lit(0)).cast("long")
    return dense.select(category, hour, n.alias(N),
                        (n / F.greatest(F.col("_max"), F.lit(1)).cast("double")).alias(value), order)
