"""Exact median without gathering the data.

``percentile``/``median`` keep every value of a group in one aggregation
buffer, so a global median over a large table runs in one task.  Here a
quantile sketch first brackets the middle ranks; histograms then narrow the
bracket: each pass buckets the values in range into ``BUCKETS`` equal-width
buckets (one grouped aggregate: count, min, max per bucket) and keeps the one
holding the middle rank.  That drops the range's least or greatest value, so
the search ends; a hot value ends it at once.  A bracket that misses the ranks
is replaced by the whole range.  Infinities rank at the ends.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
SKETCH = 10_000


def _values(df: DataFrame, column: str) -> DataFrame:
    v = F.col(column).cast("double")
    return df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _bucket(lo: float, hi: float, buckets: int):
    """Bucket of a value in [lo, hi]; halves, as the width may overflow."""
    half = 1.0 if math.isfinite(hi - lo) else 0.5
    part = (F.col("v") * F.lit(half) - F.lit(lo * half)) / F.lit(hi * half - lo * half)
    return F.least(F.floor(part * F.lit(buckets)), F.lit(buckets - 1)).cast("int")


def exact_kth(values: DataFrame, k1: int, lo: float, hi: float, below: int,
              buckets: int = BUCKETS) -> tuple[float, float]:
    """Values at 0-based ranks ``k1`` and ``k1 + 1`` (the last one twice);
    ``values`` has one finite double column ``v``, ``below`` of its values
    lie under ``lo``, and rank ``k1`` lies in [lo, hi].
    """
    while lo < hi:
        stats = values.where(F.col("v").between(lo, hi)).groupBy(_bucket(lo, hi, buckets).alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx"))
        for _b, c, mn, mx in sorted(tuple(r) for r in stats.collect()):  # <= buckets rows
            if below + c > k1:
                break
            below += c
        if below + c == k1 + 1:  # the greatest of its bucket: the next rank is the next value
            return mx, _next(values, mx)
        if (lo, hi) == (mn, mx):
            raise ArithmeticError(f"the range [{lo}, {hi}] does not shrink")
        lo, hi = mn, mx
    here = values.where(F.col("v") == lo).count()
    return lo, lo if below + here > k1 + 1 else _next(values, lo)


def _next(values: DataFrame, v: float) -> float:
    found = values.where(F.col("v") > v).agg(F.min("v").alias("v")).first()["v"]
    return v if found is None else found


def exact_median(df: DataFrame, column: str) -> float | None:
    """The median of a numeric column (mean of the two middle values when the
    count is even), nulls and NaN ignored; None for no values."""
    every = _values(df, column)
    inf = float("inf")
    finite = every.where(F.abs("v") < inf)
    row = every.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == -inf).alias("low"),
                    F.count_if(F.col("v") == inf).alias("high")).first()
    n, low, high = (int(row[c]) for c in ("n", "low", "high"))
    if n == 0:
        return None
    size = n - low - high
    ranks = [(n - 1) // 2, n // 2]
    ends = [-inf if k < low else inf if k >= low + size else None for k in ranks]
    if None in ends:
        inner = [k - low for k, e in zip(ranks, ends, strict=True) if e is None]
        got = _finite_ranks(finite, inner[0], size)
        for i, k in enumerate(ranks):
            if ends[i] is None:
                ends[i] = got[k - low - inner[0]]
    return ends[0] if n % 2 else (ends[0] + ends[1]) / 2.0


def _finite_ranks(values: DataFrame, k: int, size: int) -> tuple[float, float]:
    near = [min(1.0, max(0.0, k / size + d)) for d in (-2 / SKETCH, 2 / SKETCH)]
    row = values.agg(F.min("v").alias("mn"), F.max("v").alias("mx"),
                     F.percentile_approx("v", near, SKETCH).alias("p")).first()
    lo, hi = row["p"]
    at = values.agg(F.count_if(F.col("v") < lo).alias("below"), F.count_if(F.col("v") <= hi).alias("upto")).first()
    if at["below"] <= k < at["upto"]:
        return exact_kth(values, k, lo, hi, at["below"])
    return exact_kth(values, k, row["mn"], row["mx"], 0)


def impute_median_exact(df: DataFrame, columns) -> DataFrame:
    """Fill nulls with each column's exact median (a literal per column)."""
    fills = {}
    for c in columns:
        m = exact_median(df, c)
        fills[c] = F.coalesce(F.col(c), F.lit(m).cast("double")) if m is not None else F.col(c)
    return df.withColumns(fills)
