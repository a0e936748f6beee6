"""Train/test splits keyed by a hash of (seed, key).

``keyed_split`` is a per-row rule (no shuffle, independent of
partitioning, unlike ``randomSplit``).  ``stratified_split`` is exact: in
every class the ``ceil(fraction * n_class)`` rows with the smallest
(hash, key) go to the test side.  Ranking a class would put a hot class in
one task; instead each class's threshold is found by narrowing: counts per
class of the upper half of the hash, then of the lower half within the bucket
that holds the threshold, then of the keys of that hash.  A row then compares
itself with its class's threshold, so the split reads the rows once and is
narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed_bits, keyed_uniform
from .joins import join_bounded, settle_bounded

_HALF_BITS = 16


def keyed_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
                name: str = "is_test") -> DataFrame:
    """Row goes to test when its keyed draw is below ``test_fraction``."""
    return df.withColumn(name, keyed_uniform(f"split{seed}", key) < F.lit(float(test_fraction)))


def _reach(cells: DataFrame, value: str, target: Column, before: Column) -> DataFrame:
    """Per class, the first value at which the running count of ``cells`` (label, value, c) reaches the
    target, with the count below it; both are aggregates.  A class has at most 2^16 cells."""
    cell = F.struct(F.col(value).alias("v"), "c")
    per = cells.groupBy("label").agg(F.sort_array(F.collect_list(cell)).alias("cells"), target.alias("t"), before.alias("below"))
    start = F.struct(F.col("below").cast("long").alias("below"), F.lit(None).cast(cells.schema[value].dataType).alias("v"))

    def step(state: Column, x: Column) -> Column:
        ends = state["v"].isNull() & (state["below"] + x["c"] >= F.col("t"))
        return F.struct(F.when(state["v"].isNull() & ~ends, state["below"] + x["c"]).otherwise(state["below"]).alias("below"),
                        F.when(ends, x["v"]).otherwise(state["v"]).alias("v"))

    return per.where(F.col("t") > 0).withColumn("at", F.aggregate("cells", start, step)).select("label", "t", F.col("at.below").alias("below"), F.col("at.v").alias(value))


def class_thresholds(df: DataFrame, label: str, key: str, test_fraction: float, seed: int) -> DataFrame:
    """(label, word, key) of the last test row of each class, in the order of (hash, key)."""
    word = keyed_bits(f"split{seed}", 32, key)
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(key).alias("key"), word.alias("word"))
    count = F.count(F.lit(1)).alias("c")
    upper = F.shiftright("word", _HALF_BITS)
    first = _reach(rows.groupBy("label", upper.alias("upper")).agg(count), "upper", F.ceil(F.sum("c") * F.lit(float(test_fraction))), F.lit(0))
    inside = join_bounded(rows, first.withColumnRenamed("upper", "at"), "label", "inner").where(upper == F.col("at"))
    second = _reach(inside.groupBy("label", "word", "t", "below").agg(count), "word", F.first("t"), F.first("below"))
    second = settle_bounded(second)
    equal = join_bounded(rows, second.withColumnRenamed("word", "at"), "label", "inner").where(F.col("word") == F.col("at"))
    third = _reach(equal.groupBy("label", "key", "t", "below").agg(count), "key", F.first("t"), F.first("below"))
    return third.select("label", F.col("key").alias("_key")).join(second.select("label", F.col("word").alias("_word")), "label")


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.25, seed: int = 42,
                     name: str = "is_test") -> DataFrame:
    """Exact per-class split: the first ceil(fraction * n) rows by (hash, key).

    Rows of equal key, which no order tells apart, fall on one side; rows
    without a label are not test rows.
    """
    last = settle_bounded(class_thresholds(df, label, key, test_fraction, seed)).withColumnRenamed("label", label)
    word = keyed_bits(f"split{seed}", 32, key)
    is_test = F.coalesce((word < F.col("_word")) | ((word == F.col("_word")) & (F.col(key) <= F.col("_key"))), F.lit(False))
    return join_bounded(df, last, label).select(*df.columns, is_test.alias(name))


def split_counts(split: DataFrame, label: str, name: str = "is_test") -> DataFrame:
    """(label, n, n_test) per class, to check shares."""
    return split.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.col(name).cast("long")).alias("n_test"))
