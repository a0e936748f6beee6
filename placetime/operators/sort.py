"""Sorts, positions and top-k.

A global ``orderBy`` is a range-partitioned distributed sort; because every
sort order here ends in the unique key, the order is total and a hot
category is split across many range partitions.

``number_rows`` gives every row its position in such an order without one task
and without a copy of the table.  The ranges are fixed first: a hash-drawn
sample of the sort columns gives their bounds, which become literals, so a row
falls into the same range in every pass, whatever the partitioning, and also
when a lost task runs again.  One aggregate counts the rows of each range, rows
go to the task of their range and are numbered there, and the number of rows in
the ranges before is a literal.

``with_position`` numbers aggregated tables (one row per category or value),
which would be costly to compute for each of those passes: it keeps the sorted
table in a checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import SORT_CATEGORY, SORT_HOUR_ASC, SORT_HOUR_DESC, ColumnRoles
from ..session import ensure_checkpoint_dir
from .joins import join_bounded, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition offset in 33 bits
#: Sampled rows per range, and the fewest rows that are worth a range of their own.
SAMPLE_PER_RANGE = 64
LEAST_RANGE_ROWS = 1000

#: (column, ascending) pairs; nulls come first in an ascending column and last in a descending one.
Order = Sequence[tuple[str, bool]]


def order_columns(order: Order) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in order]


def _before(order: Order, x, y) -> Column:
    """Whether ``x`` stands before ``y``; both give a column's value by its place in the order."""
    out = F.lit(False)
    for i, (_, up) in reversed(list(enumerate(order))):
        a, b = x(i), y(i)
        first = F.coalesce(a < b, a.isNull() & b.isNotNull()) if up else F.coalesce(a > b, a.isNotNull() & b.isNull())
        out = first | (a.eqNullSafe(b) & out)
    return out


def range_bounds(df: DataFrame, order: Order, ranges: int | None = None) -> list[tuple]:
    """Rows of the sort columns that part ``df`` into about equal ranges (fewer for a small table).

    The sample is drawn by a hash of the sort columns, so it is the same in
    every run.  About ``SAMPLE_PER_RANGE`` rows per range reach the driver.
    """
    keys = df.select(*[F.col(c) for c, _ in order])
    rows = df.count()
    ranges = min(ranges or shuffle_partitions(df), rows // LEAST_RANGE_ROWS)
    if ranges < 2:
        return []
    wanted = SAMPLE_PER_RANGE * ranges
    draw = F.pmod(F.xxhash64(*[c for c, _ in order]), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = [tuple(r) for r in keys.where(draw < F.lit(wanted / rows)).orderBy(*order_columns(order)).collect()]
    return list(dict.fromkeys(sample[len(sample) * k // ranges] for k in range(1, ranges))) if sample else []


def range_index(df: DataFrame, order: Order, bounds: Sequence[tuple]) -> Column:
    """The number of bounds that a row does not stand before, by halving the list of bounds."""
    if not bounds:
        return F.lit(0)
    types = [df.schema[c].dataType for c, _ in order]
    fixed = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(b, types, strict=True))]) for b in bounds])

    def halve(state: Column, _: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        middle = F.shiftright(lo + hi, 1)
        bound = F.element_at(fixed, F.least(middle, F.lit(len(bounds) - 1)) + 1)
        before = _before(order, lambda i: F.col(order[i][0]), lambda i: bound[f"c{i}"])
        return F.struct(F.when((lo < hi) & ~before, middle + 1).otherwise(lo).alias("lo"), F.when((lo < hi) & before, middle).otherwise(hi).alias("hi"))

    steps = F.array(*[F.lit(0)] * len(bounds).bit_length())
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda s: s["lo"])


def number_rows(df: DataFrame, order: Order, name: str = "pos", ranges: int | None = None) -> DataFrame:
    """Sort by ``order`` (which must be total) and add a 1-based position; partitions come in the order, too."""
    bounds = range_bounds(df, order, ranges)
    ranged = df.withColumn("_range", range_index(df, order, bounds))
    counts = dict(tuple(r) for r in ranged.groupBy("_range").count().collect()) if bounds else {}  # a row per range
    before = [sum(counts.get(i, 0) for i in range(k)) for k in range(len(bounds) + 1)]
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order_columns(order)))
    placed = ranged.repartitionById(len(bounds) + 1, F.col("_range"))
    offset = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("_range") + 1)
    return placed.withColumn(name, offset + local).drop("_range")


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Sort an aggregated table by ``order`` (which must be total) and add a 1-based position."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order).withColumn("_rid", F.monotonically_increasing_id())
    # The range bounds and ids are fixed by one materialisation.
    tagged = tagged.checkpoint(eager=True)
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = tagged.join(F.broadcast(offsets), part == F.col("_part"))
    return out.withColumn(name, (F.col("_off") + local + F.lit(1)).cast("long")).drop("_rid", "_part", "_off")


def rank_small(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Position for an already aggregated table (one row per category, hour,
    cluster or class).  Unpartitioned window: only for bounded tables."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int, name: str = "pos") -> DataFrame:
    """First ``n`` rows by ``order`` with their position (TakeOrderedAndProject)."""
    return rank_small(df.orderBy(*order).limit(int(n)), order, name)


def category_frequency(df: DataFrame, category: str, name: str = "freq") -> DataFrame:
    """Attach each row's category size (groupby.transform('size')).

    Aggregate then join back: a window partitioned by category would put a
    hot category's rows in one task; the aggregate is map-side combined.
    """
    return join_bounded(df, df.groupBy(category).agg(F.count(F.lit(1)).alias(name)), category)


def sort_order(roles: ColumnRoles, mode: str) -> Order:
    """Sort columns for a dashboard sort mode; the key breaks ties.

    Any mode other than the three named ones sorts by category frequency
    (descending) and then hour, and needs ``freq`` (``category_frequency``).
    """
    hour, category, key = (roles.hour, True), (roles.category, True), (roles.key, True)
    if mode == SORT_HOUR_ASC:
        return [hour, category, key]
    if mode == SORT_HOUR_DESC:
        return [(roles.hour, False), category, key]
    if mode == SORT_CATEGORY:
        return [category, hour, key]
    return [("freq", False), hour, key]


def sort_rows(df: DataFrame, roles: ColumnRoles, mode: str) -> DataFrame:
    """Globally sorted rows for a sort mode (the helper column is dropped)."""
    order = order_columns(sort_order(roles, mode))
    if mode in (SORT_HOUR_ASC, SORT_HOUR_DESC, SORT_CATEGORY):
        return df.orderBy(*order)
    return category_frequency(df, roles.category).orderBy(*order).drop("freq")


def sorted_with_position(df: DataFrame, roles: ColumnRoles, mode: str, name: str = "pos") -> DataFrame:
    if mode in (SORT_HOUR_ASC, SORT_HOUR_DESC, SORT_CATEGORY):
        return number_rows(df, sort_order(roles, mode), name)
    freq = category_frequency(df, roles.category)
    return number_rows(freq, sort_order(roles, mode), name).drop("freq")


def preview(df: DataFrame, roles: ColumnRoles, n: int = 25, columns: Sequence[str] | None = None,
            mode: str = SORT_HOUR_ASC, name: str = "pos") -> DataFrame:
    """First ``n`` rows in a sort mode, projected (empty list = all columns)."""
    src = df if mode in (SORT_HOUR_ASC, SORT_HOUR_DESC, SORT_CATEGORY) else category_frequency(df, roles.category)
    order = order_columns(sort_order(roles, mode))
    out = top_rows(src, order, n, name)
    keep = list(columns) if columns else [c for c in df.columns]
    return out.select(*keep, name)
