"""Counts, shares, dense hours, summary, pivots, correlation."""

import pytest
from pyspark.sql import functions as F

from placetime.operators import aggregates as agg
from placetime.operators import correlation, pivot


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, category string, lat double, lon double, hour int")


def test_dense_hours_and_empty(spark):
    empty = frame(spark, [])
    h = agg.hourly_counts(empty, "hour").orderBy("hour").collect()
    assert [r["hour"] for r in h] == list(range(24)) and all(r["n"] == 0 for r in h)
    assert agg.summary_stats(empty, "category", "hour").collect() == [("Total Crimes", 0)]
    probs = agg.hour_probability(empty, "hour").collect()
    assert all(r["probability"] == 0.0 for r in probs)


def test_peak_least_ties_and_zero_fill(spark):
    rows = [(i, "a", 0.0, 0.0, h) for i, h in enumerate([6, 6, 7, 7, 8])]
    df = frame(spark, rows)
    r = agg.peak_least_hour(agg.hourly_counts(df, "hour"), "hour").first()
    assert r["peak_hour"] == 6  # tie 6/7 -> lowest
    assert r["least_hour"] == 0  # zero-filled hours count
    assert agg.peak_hour_present(df, "hour").first()["peak_hour"] == 6
    s = dict(agg.summary_stats(df, "category", "hour").collect())
    assert s == {"Total Crimes": 5, "Unique Crime Types": 1, "Peak Crime Hour": 6, "Least Crime Hour": 0}


def test_trailing_mean_partial_start(spark):
    df = frame(spark, [(i, "a", 0.0, 0.0, h) for i, h in enumerate([0, 0, 0, 1, 2, 2])])
    t = {r["hour"]: r["rolling_avg"] for r in agg.hourly_trend(df, "hour").collect()}
    assert t[0] == 3.0 and t[1] == 2.0 and t[2] == 2.0 and t[3] == 1.0 and t[23] == 0.0


def test_top_k_ties_and_shares(spark):
    cats = ["b"] * 3 + ["a"] * 3 + ["c"] * 2 + ["d"]
    df = frame(spark, [(i, c, 0.0, 0.0, 1) for i, c in enumerate(cats)])
    top = [(r["category"], r["n"], r["pos"]) for r in agg.top_k(df, "category", 2).orderBy("pos").collect()]
    assert top == [("a", 3, 1), ("b", 3, 2)]
    share = {r["category"]: r["share"] for r in agg.top_k_share(df, "category", 2).collect()}
    assert share == {"a": 0.5, "b": 0.5}
    best = agg.top_category(df, "category").first()
    assert best["category"] == "a" and abs(best["share"] - 3 / 9) < 1e-12


def test_row_stats(spark):
    df = frame(spark, [(1, "a", 1.0, 1.0, 3), (2, "a", 1.0, 1.0, 5), (3, "b", 2.0, 1.0, 9)])
    r = agg.row_stats(df, "category", "hour", "lat", "lon").first()
    assert (r["n_rows"], r["n_categories"], r["min_hour"], r["max_hour"], r["n_points"], r["min_class"]) == (
        3, 2, 3, 9, 2, 1)


def test_pivot_wide_and_heatmap(spark):
    df = frame(spark, [(1, "a", 0.0, 0.0, 1), (2, "a", 0.0, 0.0, 1), (3, "a", 0.0, 0.0, 2), (4, "b", 0.0, 0.0, 2)])
    w = {r["category"]: r for r in pivot.pivot_wide(df, "category", "hour").collect()}
    assert w["a"]["h1"] == 2 and w["a"]["h2"] == 1 and w["a"]["h0"] == 0 and w["b"]["h2"] == 1
    hm = {(r["category"], r["hour"]): (r["value"], r["row_order"])
          for r in pivot.heatmap_normalized(df, "category", "hour").collect()}
    assert hm == {("a", 1): (1.0, 1), ("a", 2): (0.5, 1), ("b", 1): (0.0, 2), ("b", 2): (1.0, 2)}


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(float(i), 5.0, float(2 * i)) for i in range(10)], "a double, b double, c double")
    m = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] is None and m[("b", "b")] is None
    assert m[("a", "c")] == pytest.approx(1.0) and m[("c", "a")] == pytest.approx(1.0)
    top = correlation.strongest_pairs(correlation.corr_matrix(df, ["a", "b", "c"]), 5).collect()
    assert [r["pair"] for r in top] == ["a vs c"]


def test_correlation_listwise_deletion(spark):
    df = spark.createDataFrame([(1.0, 2.0, True), (2.0, 4.0, True), (3.0, 1.0, False), (4.0, 9.0, True)],
                               "a double, b double, _valid boolean")
    m = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.corr_matrix(df, ["a", "b"]).collect()}
    want = df.where("_valid").agg(F.corr("a", "b")).first()[0]
    assert m[("a", "b")] == pytest.approx(want)


def test_correlation_of_infinite_and_large_values(spark):
    rows = [(float(i), 1e9 + i % 3, float("inf") if i == 4 else float(i * i), float("-inf") if i % 2 else 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    m = correlation.corr_matrix(df, ["a", "b", "c", "d"])
    assert m._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    r = {(x["feature_a"], x["feature_b"]): x["r"] for x in m.collect()}
    assert all(v is None for (x, y), v in r.items() if x in "cd" or y in "cd")
    want = df.select(F.corr("a", F.col("b") - 1e9)).first()[0]
    assert r["a", "b"] == pytest.approx(want, abs=1e-9) and r["a", "a"] == pytest.approx(1.0)
    assert all(x["r"] is None for x in correlation.corr_matrix(df.limit(0), ["a", "b"]).collect())


def test_hour_count_corr_flat_is_null(spark):
    df = frame(spark, [(h, "a", 0.0, 0.0, h) for h in range(24)])
    h = agg.hourly_counts(df, "hour").select(F.col("hour").cast("double").alias("hour"),
                                             F.col("n").cast("double").alias("n"))
    assert correlation.hour_count_corr(h, "hour", "n").first()["r"] is None


def test_correlation_stable_for_large_offsets(spark):
    import random

    random.seed(3)
    rows = []
    for _ in range(2000):
        a = random.gauss(0, 1)
        rows.append((1e9 + a, 5e8 + 0.5 * a + random.gauss(0, 1), True))
    rows.insert(0, (None, 7.0, False))  # invalid first row: its null shifts by 0, its row is excluded
    df = spark.createDataFrame(rows, "a double, b double, _valid boolean")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.corr_matrix(df, ["a", "b"]).collect()}
    xs = [(x, y) for x, y, v in rows if v]
    n = len(xs)
    ma, mb = sum(x for x, _ in xs) / n, sum(y for _, y in xs) / n
    cab = sum((x - ma) * (y - mb) for x, y in xs)
    caa = sum((x - ma) ** 2 for x, _ in xs)
    cbb = sum((y - mb) ** 2 for _, y in xs)
    want = cab / (caa * cbb) ** 0.5
    assert got[("a", "b")] == pytest.approx(want, abs=1e-6)
