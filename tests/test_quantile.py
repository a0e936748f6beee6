"""Exact median by histogram narrowing, against Python's median."""

import random
import statistics

import pytest

from placetime.operators import quantile as qt

random.seed(7)
CASES = {
    "uniform_odd": [random.random() for _ in range(3001)],
    "uniform_even": [random.random() for _ in range(3000)],
    "bimodal_split": [0.0] * 1500 + [1.0] * 1500,
    "hot_value": [3.5] * 1000 + [random.gauss(0, 1) for _ in range(2000)],
    "single": [7.0],
    "pair": [1.0, 4.0],
    "duplicates": [float(i % 7) for i in range(2001)],
    "heavy_tail": [random.expovariate(1) ** 6 for _ in range(3000)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_exact_median(spark, name):
    vals = CASES[name]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "x double")
    want = statistics.median(vals)
    assert qt.exact_median(df, "x") == want
    # Force several histogram passes with few buckets.
    v = qt._values(df, "x")
    lo, hi = v.agg({"v": "min"}).first()[0], v.agg({"v": "max"}).first()[0]
    n = len(vals)
    a, b = qt.exact_kth(v, (n - 1) // 2, lo, hi, 0, buckets=4)
    assert (a if n % 2 else (a + b) / 2) == want


def test_infinities_and_wide_ranges(spark):
    inf = float("inf")
    for vals in ([inf] * 3 + [1.0, 2.0] * 20, [-inf, -inf, 3.0], [inf, inf, 1.0, 2.0], [-1.7e308, 1.7e308, 5.0, 6.0],
                 [-inf] * 5 + [5e-324, 1e-323, 0.0, inf] * 2):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        assert qt.exact_median(df, "x") == statistics.median(vals)


def test_empty_and_impute(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0), (4, 3.0)], "k long, x double")
    assert qt.exact_median(df.where("x is null"), "x") is None
    out = {r["k"]: r["x"] for r in qt.impute_median_exact(df, ["x"]).collect()}
    assert out == {1: 3.0, 2: 5.0, 3: 1.0, 4: 3.0}
