"""Counts, shares, top-k, dense hourly series, summary table and the
trailing hourly mean.

Every aggregate is a grouped ``agg`` (partial aggregation before the
shuffle, so a hot category costs one partial row per task, not a hot
partition).  Whole-table totals are windows over the already aggregated
table (one row per category or hour), so the rows are scanned once and no
cross join is needed; only such small results are ranked with unpartitioned
windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import SUMMARY_METRICS
from .joins import complete_domain, hour_domain
from .sort import rank_small, with_position

N = "n"


def _count() -> F.Column:
    return F.count(F.lit(1))


def category_counts(df: DataFrame, category: str, name: str = N) -> DataFrame:
    """Count per category (order: count desc, then category)."""
    return df.groupBy(category).agg(_count().alias(name))


def ranked_counts(df: DataFrame, category: str, name: str = N, pos: str = "pos") -> DataFrame:
    counts = category_counts(df, category, name)
    return with_position(counts, [F.col(name).desc(), F.col(category).asc()], pos)


def top_k(df: DataFrame, category: str, k: int, name: str = N, pos: str = "pos") -> DataFrame:
    """The ``k`` most frequent categories; ties broken by name."""
    counts = category_counts(df, category, name)
    order = [F.col(name).desc(), F.col(category).asc()]
    return rank_small(counts.orderBy(*order).limit(int(k)), order, pos)


def category_share(df: DataFrame, category: str, name: str = N, share: str = "share") -> DataFrame:
    """Count and share of all rows per category (value_counts(normalize)).

    The total is a scalar over the per-category table, which is computed once.
    """
    return share_of_counts(category_counts(df, category, name), name, share)


def share_of_counts(counts: DataFrame, name: str = N, share: str = "share") -> DataFrame:
    """Add each row's share of the sum of counts."""
    from .joins import materialize_small

    counts = materialize_small(counts)
    return counts.withColumn(share, F.try_divide(F.col(name).cast("double"), counts.agg(F.sum(name)).scalar()))


def top_k_share(df: DataFrame, category: str, k: int = 10, name: str = N, share: str = "share",
                pos: str = "pos") -> DataFrame:
    """Shares within the top ``k`` only (the pie over the shown slices)."""
    top = top_k(df, category, k, name, pos)
    return top.withColumn(share, F.col(name) / F.sum(name).over(Window.partitionBy()).cast("double"))


def top_category(df: DataFrame, category: str, share: str = "share") -> DataFrame:
    """Most frequent category and its share (first by name on ties)."""
    s = category_share(df, category, N, share)
    best = s.agg(F.min_by(F.struct(F.col(category), F.col(share)),
                          F.struct((-F.col(N)).alias("m"), F.col(category).alias("c"))).alias("b"))
    return best.select(F.col("b")[category].alias(category), F.col("b")[share].alias(share))


def hourly_counts(df: DataFrame, hour: str, name: str = N) -> DataFrame:
    """Dense 0..23 counts with zeros (groupby + reindex(range(24))).

    Only hours 0..23 can join the domain, so only they are counted: the
    aggregate has at most 24 rows by construction and is broadcast onto the
    24-row domain.  An empty input gives 24 zeros.
    """
    h = F.col(hour).cast("int")
    counts = df.where(h.between(0, 23)).groupBy(h.alias(hour)).agg(_count().alias(name))
    return complete_domain(counts, hour_domain(df.sparkSession, hour), hour, {name: 0})


def trailing_mean(hourly: DataFrame, hour: str, value: str = N, window: int = 3,
                  name: str = "rolling_avg") -> DataFrame:
    """Trailing mean over ``window`` hours, partial at the start, not circular.

    Runs on the 24-row dense series, so the unpartitioned window is bounded.
    """
    w = Window.orderBy(hour).rowsBetween(-(int(window) - 1), 0)
    return hourly.withColumn(name, F.avg(F.col(value).cast("double")).over(w))


def hourly_trend(df: DataFrame, hour: str, window: int = 3) -> DataFrame:
    return trailing_mean(hourly_counts(df, hour), hour, N, window)


def peak_least_hour(hourly: DataFrame, hour: str, value: str = N) -> DataFrame:
    """Peak and least hour of the dense series; the lowest hour wins ties.

    Least considers zero-filled hours outside any filter range, as the
    original does.
    """
    return hourly.agg(
        F.max_by(hour, F.struct(F.col(value), -F.col(hour))).alias("peak_hour"),
        F.min_by(hour, F.struct(F.col(value), F.col(hour))).alias("least_hour"),
    )


def peak_hour_present(df: DataFrame, hour: str) -> DataFrame:
    """Most frequent hour among hours present (lowest on ties)."""
    counts = df.groupBy(hour).agg(_count().alias(N))
    return counts.agg(F.max_by(hour, F.struct(F.col(N), -F.col(hour))).alias("peak_hour"))


def hour_probability(df: DataFrame, hour: str, name: str = "probability") -> DataFrame:
    """Dense hourly counts divided by their total; a zero total gives zeros."""
    hourly = hourly_counts(df, hour)
    total = F.sum(N).over(Window.partitionBy())
    return hourly.withColumn(name, F.coalesce(F.try_divide(F.col(N).cast("double"), total), F.lit(0.0)))


def summary_stats(df: DataFrame, category: str, hour: str) -> DataFrame:
    """(metric, value) rows: total, distinct categories, peak and least hour.

    One scan: the (hour, category) counts are materialised once; the distinct
    category count is a distributed aggregate over them, and the per-hour
    counts (<= 24 rows) give total, peak and least hour.  The least hour
    counts zero-filled hours: the smallest missing hour, if any, has the
    least count.  An empty input gives the single row ``Total Crimes, 0``.
    """
    from .joins import materialize_small

    cells = materialize_small(df.groupBy(F.col(hour).cast("int").alias(hour), category).agg(_count().alias(N)))
    distinct = cells.select(F.count_distinct(category)).scalar()
    per_hour = cells.groupBy(hour).agg(F.sum(N).alias(N))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(23)), F.collect_list(hour))
    one = per_hour.agg(
        F.coalesce(F.sum(N), F.lit(0)).alias("total"),
        F.max_by(hour, F.struct(F.col(N), -F.col(hour))).alias("peak_hour"),
        F.coalesce(F.array_min(missing), F.min_by(hour, F.struct(F.col(N), F.col(hour)))).alias("least_hour"),
    ).withColumn("distinct", distinct)
    m = SUMMARY_METRICS
    rows = one.select(F.inline(F.array(
        F.struct(F.lit(m[0]).alias("metric"), F.col("total").cast("long").alias("value"), F.lit(0).alias("i")),
        F.struct(F.lit(m[1]).alias("metric"), F.col("distinct").cast("long").alias("value"), F.lit(1).alias("i")),
        F.struct(F.lit(m[2]).alias("metric"), F.col("peak_hour").cast("long").alias("value"), F.lit(2).alias("i")),
        F.struct(F.lit(m[3]).alias("metric"), F.col("least_hour").cast("long").alias("value"), F.lit(3).alias("i")),
    )), F.col("total"))
    return rows.where((F.col("i") == 0) | (F.col("total") > 0)).select("metric", "value")


def centroid(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.agg(F.avg(lat).alias("avg_lat"), F.avg(lon).alias("avg_lon"))


def distinct_sorted(df: DataFrame, column: str, pos: str = "pos") -> DataFrame:
    """Sorted distinct values."""
    return with_position(df.select(column).distinct(), [F.col(column).asc()], pos)


def row_stats(df: DataFrame, category: str, hour: str, lat: str, lon: str) -> DataFrame:
    """Row count, distinct categories, min/max hour, distinct points and the
    smallest class size.  Categories and classes come from the category counts;
    only the points are counted as distinct rows, so no row is doubled."""
    base = df.agg(
        _count().alias("n_rows"),
        F.min(hour).alias("min_hour"),
        F.max(hour).alias("max_hour"),
        F.count_distinct(lat, lon).alias("n_points"),
    )
    classes = category_counts(df, category).agg(F.count(category).alias("k"), F.min(N).alias("m"))
    both = classes.select(F.struct("k", "m")).scalar()
    return base.withColumns({"n_categories": both["k"], "min_class": both["m"]})
