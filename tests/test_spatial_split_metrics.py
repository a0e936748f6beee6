"""Spatial operators, splits and classification metrics."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from placetime.functions import keyed_bits
from placetime.operators import metrics, spatial, split
from placetime.roles import MAP_ALL, MAP_INTENSITY, MAP_TYPE, ColumnRoles

ROLES = ColumnRoles()


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, category string, lat double, lon double, hour int")


@pytest.mark.parametrize("n,points,k", [(0, 0, 0), (2, 2, 0), (19, 1, 0), (19, 19, 2), (20, 20, 2),
                                         (250, 250, 3), (1000, 1000, 6), (5000, 5000, 6), (3, 3, 2)])
def test_cluster_count_rule(spark, n, points, k):
    rule = spatial.cluster_count_expr(F.lit(n), F.lit(points > 1))
    assert spark.range(1).select(rule.alias("k")).first()["k"] == k


def test_cluster_plan_expr_matches_rule(spark):
    df = frame(spark, [(i, "a", 28.4 + i * 1e-3, 77.0, 1) for i in range(600)])
    r = spatial.cluster_plan(df, "lat", "lon").first()
    assert (r["n"], r["multi_point"], r["k"]) == (600, True, 4)
    same = frame(spark, [(i, "a", 28.4, 77.0, 1) for i in range(30)])
    r = spatial.cluster_plan(same, "lat", "lon").first()
    assert (r["n"], r["multi_point"], r["k"]) == (30, False, 0)


def test_nearest_center_ties_pick_lowest(spark):
    df = frame(spark, [(1, "a", 0.0, 0.0, 1), (2, "a", 1.0, 1.0, 1)])
    out = spatial.assign_centers(df, "lat", "lon", [(1.0, 0.0), (0.0, 1.0), (1.0, 1.0)]).orderBy("key").collect()
    assert [r["cluster"] for r in out] == [0, 2]
    assert out[0]["cluster_id"] == "0"


def test_density_grid_bins_and_degenerate(spark):
    df = frame(spark, [(1, "a", 0.0, 0.0, 1), (2, "a", 1.0, 1.0, 1), (3, "a", 0.5, 0.5, 1)])
    g = {(r["x_bin"], r["y_bin"]): r["n"] for r in spatial.density_grid(df, "lon", "lat").collect()}
    assert g == {(0, 0): 1, (29, 29): 1, (15, 15): 1}
    same = frame(spark, [(1, "a", 2.0, 3.0, 1), (2, "a", 2.0, 3.0, 1)])
    g = {(r["x_bin"], r["y_bin"]): r["n"] for r in spatial.density_grid(same, "lon", "lat").collect()}
    assert g == {(15, 15): 2}


def test_slots_and_legends(spark):
    cats = [f"c{i:02d}" for i in range(15)]
    df = frame(spark, [(i, c, 1.0, 1.0, 3) for i, c in enumerate(cats)])
    slots = {r["category"]: r["slot"] for r in spatial.category_slots(df, "category").collect()}
    assert slots["c00"] == 0 and slots["c10"] == 0 and slots["c14"] == 4
    leg = spatial.legend(df, ROLES, MAP_TYPE).orderBy("pos").collect()
    assert len(leg) == 12 and leg[0]["label"] == "c00"
    assert spatial.legend(df, ROLES, MAP_INTENSITY).count() == 3
    assert [r["label"] for r in spatial.legend(df, ROLES, MAP_ALL).collect()] == ["All Crimes"]
    assert spatial.legend(frame(spark, []), ROLES, MAP_ALL).count() == 0
    ids = spark.createDataFrame([("10",), ("9",), ("2",)], "cluster string")
    order = [r["cluster"] for r in spatial.cluster_slots(ids, "cluster").orderBy("idx").collect()]
    assert order == ["2", "9", "10"]


def test_map_points_modes(spark):
    df = frame(spark, [(1, "a", 1.0, 1.0, 3), (2, "b", None, 1.0, 20)])
    assert spatial.map_points(df, ROLES, MAP_INTENSITY).collect()[0]["intensity"] == "Low"
    assert spatial.map_points(df, ROLES, MAP_TYPE).count() == 1
    assert spatial.map_points(df, ROLES, "anything").columns == ["category", "lat", "lon", "hour"]


def test_kmeans_fit_restarts_and_attach(spark):
    rows = [(i, "a", 28.4 + (i % 2) * 0.4 + (i % 7) * 1e-3, 77.0 + (i % 2) * 0.4, 1) for i in range(300)]
    df = frame(spark, rows)
    out, fit = spatial.attach_clusters(df, ROLES, restarts=2)
    assert fit is not None and fit.k == 3 and len(fit.centers) == 3
    assert fit.centers == sorted(fit.centers)
    ids = {r["cluster_id"] for r in out.collect()}
    assert ids <= {"0", "1", "2"}
    tiny, none = spatial.attach_clusters(frame(spark, [(1, "a", 1.0, 1.0, 1), (2, "a", 1.0, 1.0, 1)]), ROLES)
    assert none is None and {r["cluster_id"] for r in tiny.collect()} == {"0"}


def test_kmeans_restarts_share_rounds(spark):
    rng = np.random.default_rng(1)
    xy = np.concatenate([rng.normal(c, 0.02, (150, 2)) for c in ((28.4, 77.0), (28.8, 77.4), (28.4, 77.4))])
    df = frame(spark, [(i, "a", float(a), float(b), 1) for i, (a, b) in enumerate(xy)])
    fit = spatial.fit_kmeans(df, "lat", "lon", 3, restarts=4, key="key")
    centers = np.array(fit.centers)
    near = ((xy[:, None] - centers) ** 2).sum(2)
    means = np.array([xy[near.argmin(1) == i].mean(0) for i in range(3)])
    assert np.allclose(means, centers, atol=1e-9) and fit.cost == pytest.approx(near.min(1).sum())
    # The same fit under another partitioning; without a key the draws follow the coordinates.
    again = spatial.fit_kmeans(df.repartition(5), "lat", "lon", 3, restarts=4, key="key")
    assert again.restart == fit.restart and np.allclose(again.centers, centers, atol=1e-9)
    assert np.allclose(spatial.fit_kmeans(df, "lat", "lon", 3, restarts=4).centers, centers, atol=0.02)
    # Seeding takes each point at most once, and ends where all points are centers.
    few = frame(spark, [(1, "a", 1.0, 1.0, 1), (2, "a", 2.0, 2.0, 1), (3, "a", None, 2.0, 1), (4, "a", float("nan"), 2.0, 1)])
    seeds = spatial.seed_centers(few.where("key < 3").select("lat", "lon", "key"), 3, 42, 2)
    assert all(set(c) == {(1.0, 1.0), (2.0, 2.0)} and len(c) == 3 for c in seeds.values())
    assert spatial.fit_kmeans(few, "lat", "lon", 2).cost == 0


def _brute_strat(df, frac, seed):
    w = keyed_bits(f"split{seed}", 32, "key")
    win = Window.partitionBy("category").orderBy(w, "key")
    n = F.count(F.lit(1)).over(Window.partitionBy("category"))
    b = df.withColumn("t", F.row_number().over(win) <= F.ceil(n * frac))
    return {r["key"]: r["t"] for r in b.collect()}


def test_stratified_split_exact_with_hot_class(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 7}", 0.0, 0.0, 1) for i in range(3000)] + [(5000, "single", 0.0, 0.0, 1)]
    df = frame(spark, rows).select("key", "category")
    want = _brute_strat(df, 0.25, 42)
    for parts in (1, 5):
        got = {r["key"]: r["is_test"] for r in split.stratified_split(df.repartition(parts), "category", "key").collect()}
        assert got == want
    counts = {r["category"]: (r["n"], r["n_test"]) for r in split.split_counts(
        split.stratified_split(df, "category", "key"), "category").collect()}
    assert all(t == math.ceil(0.25 * n) for n, t in counts.values())


def test_stratified_split_reads_rows_once_and_keeps_edges(spark, scratch):
    rows = [(i, None if i % 50 == 0 else f"c{i % 3}") for i in range(900)] + [(5, "twice"), (5, "twice"), (6, "twice"), (7, "one")]
    spark.createDataFrame(rows, "key long, label string").write.parquet(scratch + "/rows")
    df = spark.read.parquet(scratch + "/rows")
    out = split.stratified_split(df, "label", "key", 0.25)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan and out.columns == ["key", "label", "is_test"]
    got = out.collect()
    assert len(got) == len(rows) and not any(r["is_test"] for r in got if r["label"] is None)
    for c in ("c0", "c1", "c2"):
        n = sum(r["label"] == c for r in got)
        assert sum(r["is_test"] for r in got if r["label"] == c) == math.ceil(0.25 * n)
    assert len({r["is_test"] for r in got if r["key"] == 5 and r["label"] == "twice"}) == 1
    assert not any(r["is_test"] for r in split.stratified_split(df, "label", "key", 0.0).collect())
    assert all(r["is_test"] for r in split.stratified_split(df.where("label is not null"), "label", "key", 1.0).collect())
    assert split.stratified_split(df.limit(0), "label", "key").count() == 0


def test_keyed_split_share(spark):
    df = spark.range(20000).withColumnRenamed("id", "key")
    share = split.keyed_split(df, "key", 0.2).agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert abs(share - 0.2) < 0.02


def test_metrics_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "c")] + [("c", "a")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    assert metrics.accuracy(df).first()[0] == pytest.approx(5 / 8)
    cm = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[("a", "a")] == 3 and cm[("c", "c")] == 0
    rep = {r["label"]: r for r in metrics.classification_report(df).collect()}
    assert rep["a"]["precision"] == pytest.approx(3 / 4) and rep["a"]["recall"] == pytest.approx(3 / 4)
    assert rep["c"]["precision"] == 0.0 and rep["c"]["f1"] == 0.0  # zero division -> 0
    acc = rep["accuracy"]
    assert acc["precision"] == acc["recall"] == acc["f1"] == acc["support"] == pytest.approx(5 / 8)
    assert rep["macro avg"]["support"] == 8.0
    wp = (3 / 4 * 4 + 2 / 3 * 3 + 0 * 1) / 8
    assert rep["weighted avg"]["precision"] == pytest.approx(wp)
    assert [r["label"] for r in metrics.classification_report(df).orderBy("pos").collect()] == [
        "a", "b", "c", "accuracy", "macro avg", "weighted avg"]


def test_kmeans_points_are_held_before_the_filter(spark, monkeypatch):
    """Passes read held coordinates; the filter for finite ones does not work them out again."""
    seen = {}
    monkeypatch.setattr(spatial, "seed_centers", lambda points, *_: seen.update(plan=points._jdf.queryExecution().optimizedPlan().toString()) or {0: [(0.0, 0.0), (1.0, 1.0)]})
    df = spark.range(50).selectExpr("id AS key", "conv(substring(md5(CAST(id AS STRING)), 1, 4), 16, 10) / 65536D AS lat", "id / 50D AS lon")
    spatial.fit_kmeans(df, "lat", "lon", 2, restarts=1, key="key")
    above, held = seen["plan"].split("InMemoryRelation", 1)
    assert "Filter" in above and "md5" not in above
    assert not any("md5" in line.split("Filter", 1)[1] for line in held.splitlines() if "Filter" in line)


def test_kmeans_draws_match_the_keyed_uniform(spark):
    """A seeding draw is the point of least -ln(1 - u) / w, with u as in SQL."""
    from placetime.functions.hashing import keyed_uniform_sql

    points = spark.range(500).selectExpr("id AS key", "(id % 23) / 7D AS lat", "(id % 31) / 9D AS lon").repartition(3).cache()
    got = spatial.seed_centers(points, 3, 42, 6)
    for r, own in got.items():
        for step in range(3):
            away = "1D" if not step else "least(" + ", ".join(f"pow(lat - {a!r}D, 2) + pow(lon - {b!r}D, 2)" for a, b in [*own[:step], own[0]]) + ")"
            u = keyed_uniform_sql(f"km42-{step}-{r // 4}", "key", r % 4)
            best = points.selectExpr("lat", "lon", "key", f"{away} AS w", f"-ln(1D - {u}) AS e").where("w > 0").orderBy(F.expr("e / w"), "key").first()
            assert own[step] == (best["lat"], best["lon"])
