"""Values that once changed results: incomplete first rows, NaN, infinity, null hours, JVM patterns."""

import math

import pytest

from placetime.operators import correlation, filters, pivot, spatial


def test_correlation_does_not_depend_on_the_first_rows(spark):
    rows = [(None, None)] * 1500 + [(1e9 + i, 1e9 + 2 * i + (i * 7919 % 11)) for i in range(1500)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(1)
    df = df.selectExpr("a", "b", "a is not null and b is not null as _valid")
    r = {(x["feature_a"], x["feature_b"]): x["r"] for x in correlation.corr_matrix(df, ["a", "b"]).collect()}
    assert r["a", "b"] == pytest.approx(0.99999, abs=1e-4) and r["a", "a"] == pytest.approx(1)


def test_grid_ignores_points_that_are_not_finite(spark):
    pts = [(28.1, 77.1), (28.2, 77.2), (math.nan, 77.3), (28.3, math.inf), (None, 1.0)]
    out = spatial.density_grid(spark.createDataFrame(pts, "x double, y double"), "x", "y", 4).collect()
    assert sorted((r["x_bin"], r["y_bin"], r["n"]) for r in out) == [(0, 0, 1), (3, 3, 1)]


def test_heatmap_drops_null_hours(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "c string, h int")
    out = pivot.heatmap_normalized(df, "c", "h").collect()
    assert sorted((r["c"], r["h"], r["n"]) for r in out) == [("a", 1, 1), ("a", 2, 0), ("b", 1, 0), ("b", 2, 1)]


def test_patterns_follow_the_executor(spark):
    assert filters.validate_pattern(r"\p{L}+") == r"\p{L}+"
    with pytest.raises(ValueError):
        filters.validate_pattern("(?P<a>x)")
