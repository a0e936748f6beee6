"""Node tables of forests: growth by levels and in tasks, scoring, importances, native models."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from placetime.operators import grow, ml, predict, trees


@pytest.fixture(scope="module")
def points(spark):
    """Two classes parted by x0, a third by x1, with noise and a constant feature."""
    rng = np.random.default_rng(5)
    x = np.round(rng.random((600, 3)), 2)
    x[:, 2] = 1.0
    label = np.where(x[:, 0] < 0.4, 0, np.where(x[:, 1] < 0.7, 1, 2))
    label = np.where(rng.random(600) < 0.1, rng.integers(0, 3, 600), label)
    rows = [(i, float(c), [float(v) for v in p]) for i, (c, p) in enumerate(zip(label, x, strict=True))]
    return spark.createDataFrame(rows, "key long, label double, x array<double>").cache()


def table(nodes):
    return sorted((r["tree"], r["node"], r["feature"], r["threshold"], r["left"], r["right"], r["rows"], tuple(round(w, 6) for w in r["weights"]), round(r["gain"], 9))
                  for r in nodes.collect())


def native(spark, nodes, points, n):
    to_vector = F.udf(lambda v: Vectors.dense(v), VectorUDT())
    vectors = points.withColumn("features", to_vector("x"))
    template = ml.forest(ml.ForestPreset(n, 0)).fit(vectors.select("label", "features"))
    return trees.as_model(nodes, template), vectors


@pytest.mark.parametrize("balanced", [False, True])
def test_levels_and_tasks_grow_the_same_trees(points, monkeypatch, balanced):
    g = grow.Growth(5, 4, min_leaf=3, min_split=8, balanced=balanced, features=3)
    in_tasks = table(grow.grow_forest(points, "key", "label", "x", 3, 3, g))
    monkeypatch.setattr(grow, "FINISH_ROWS", 40)  # large nodes by aggregates, small ones in tasks
    mixed = table(grow.grow_forest(points, "key", "label", "x", 3, 3, g))
    monkeypatch.setattr(grow, "FINISH_ROWS", 0)
    monkeypatch.setattr(grow, "GROUP_TREES", 2)
    by_level = table(grow.grow_forest(points.repartition(3), "key", "label", "x", 3, 3, g))
    assert in_tasks == mixed == by_level and len({t[0] for t in in_tasks}) == 5


def test_growth_rules_and_bags(spark, points):
    g = grow.Growth(3, 5, min_leaf=4, min_split=20, features=3, seed=7)
    nodes = {(r["tree"], r["node"]): r for r in grow.grow_forest(points, "key", "label", "x", 3, 3, g).collect()}
    data = {r["key"]: r for r in points.collect()}
    for tree in range(3):
        bag = [(data[r["key"]], r["copies"]) for r in grow.bags(points, "key", tree, tree + 1, 7).collect()]
        assert 0.55 < len(bag) / 600 < 0.72

        def check(place, rows, depth, tree=tree):
            n = nodes[tree, place]
            want = np.bincount([int(r["label"]) for r, _ in rows], [c for _, c in rows], 3)
            assert n["rows"] == len(rows) >= 4 and np.allclose(n["weights"], want) and depth <= 5
            if n["feature"] < 0:
                return 1
            assert n["feature"] != 2 and len(rows) >= 20 and depth < 5
            left = [x for x in rows if x[0]["x"][n["feature"]] <= n["threshold"]]
            right = [x for x in rows if x[0]["x"][n["feature"]] > n["threshold"]]
            gini = lambda part: 1 - sum((sum(c for r, c in part if r["label"] == k) / sum(c for _, c in part)) ** 2 for k in range(3))
            total = sum(c for _, c in rows)
            gain = gini(rows) - sum(sum(c for _, c in part) / total * gini(part) for part in (left, right))
            assert n["gain"] == pytest.approx(gain)
            return 1 + check(n["left"], left, depth + 1) + check(n["right"], right, depth + 1)

        assert check(0, bag, 0) == sum(t == tree for t, _ in nodes)


def test_native_model_and_expression_agree(spark, points):
    g = grow.Growth(4, 6, balanced=True)
    nodes = grow.grow_forest(points, "key", "label", "x", 3, 3, g)
    model, vectors = native(spark, nodes, points, 4)
    assert model.totalNumNodes == nodes.count() and model.getNumTrees == 4
    scored = model.transform(vectors).select("label", "prediction", vector_to_array("probability").alias("p"), "x")
    both = scored.withColumn("q", trees.forest_probability(nodes, "x", 6))
    off = F.max(F.array_max(F.zip_with("p", "q", lambda a, b: F.abs(a - b))))
    row = both.agg(off.alias("off"), F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("right")).first()
    assert row["off"] < 1e-12 and row["right"] > 0.85
    own = {r["feature"]: r["importance"] for r in trees.gain_importance(nodes).collect()}
    assert [own.get(i, 0.0) for i in range(3)] == pytest.approx(model.featureImportances.toArray().tolist())
    # Read back, the model has the same nodes (the saved form numbers them in preorder).
    content = lambda df: sorted((t[0], t[2], t[3] is None, t[3], *t[7:]) for t in table(df.withColumn("rows", F.lit(0))))
    assert content(trees.forest_nodes(spark, model).fillna({"threshold": -1.0})) == content(nodes.fillna({"threshold": -1.0}))


def test_forest_of_little(spark, points):
    one_class = points.where("label = 1").limit(30)
    nodes = grow.grow_forest(one_class, "key", "label", "x", 3, 3, grow.Growth(2, 3)).collect()
    assert len(nodes) == 2 and all(r["feature"] == -1 and r["node"] == 0 for r in nodes)
    flat = points.limit(40).withColumn("x", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    assert grow.grow_forest(flat, "key", "label", "x", 3, 3, grow.Growth(2, 3)).count() == 2


def test_level_splits_of_many_nodes_match_each_alone():
    """All nodes of a level are split at once: the best cut of each is the one found by trying its cuts."""
    rng = np.random.default_rng(3)
    n, g = 900, grow.Growth(1, 5, min_leaf=4)
    group, label, bins = rng.integers(0, 12, n), rng.integers(0, 3, n), rng.integers(0, 7, (n, 5))
    bins[group == 7] = 2  # a node without a cut
    w = rng.integers(1, 4, n).astype(float)
    features = grow._drawn_features(np.arange(12) + 40, 6, 3, 5, 42)
    assert (features == grow._drawn_features(np.arange(12) + 40, 6, 3, 5, 42)).all() and (np.diff(features, axis=1) > 0).all()
    f, b, gain = grow._level_splits(group, label, bins, w, features, 3, g)
    gini = lambda on: 1 - sum((w[on & (label == k)].sum() / w[on].sum()) ** 2 for k in range(3))
    for node in range(12):
        own, best = group == node, (1e-12, -1, 0)
        for c in features[node].tolist():
            for cut in range(7):
                left, right = own & (bins[:, c] <= cut), own & (bins[:, c] > cut)
                if left.sum() >= 4 and right.sum() >= 4:
                    value = gini(own) - sum(w[part].sum() / w[own].sum() * gini(part) for part in (left, right))
                    best = (value, c, cut) if value > best[0] + 1e-11 else best
        assert (f[node], b[node] if f[node] >= 0 else 0) == best[1:] and (f[node] < 0 or gain[node] == pytest.approx(best[0]))
    drawn = grow._drawn_features(np.arange(4000), 1, 3, 12, 7)
    assert np.allclose(np.bincount(drawn.ravel(), minlength=12) / 4000, 0.25, atol=0.05)


@pytest.mark.parametrize("balanced", [False, True])
def test_table_forest_scores_as_the_native_one(spark, points, monkeypatch, balanced):
    """Trees that stay in a table, scored by groups of trees and blocks of cells, against the native model of the same nodes."""
    monkeypatch.setattr(trees, "SCORE_ROWS", 100)
    g = grow.Growth(5, 6, balanced=balanced)
    packed, cuts = grow.grow_trees(points, "key", "label", "x", 3, 3, g)
    held = trees.TableForest(packed, cuts, 3)
    model, vectors = native(spark, trees.node_table(packed, cuts, 3), points, 5)
    assert (held.getNumTrees, held.totalNumNodes, held.numFeatures) == (5, model.totalNumNodes, 3)
    assert held.featureImportances.toArray().tolist() == pytest.approx(model.featureImportances.toArray().tolist())
    # Rows twice and values that training has not seen.
    odd = spark.createDataFrame([(-1, Vectors.dense([-9.0, 9.0, float("inf")])), (-2, Vectors.sparse(3, [1], [0.4]))], ["key", "features"])
    rows = vectors.select("key", "features").union(vectors.where("key < 50").select("key", "features")).union(odd)
    columns = ["key", "features", "rawPrediction", "probability", "prediction"]
    own, want = (sorted(([tuple(v.toArray()) if hasattr(v, "toArray") else v for v in r] for r in m.transform(rows).select(*columns).collect())) for m in (held, model))
    assert len(own) == 652 and len({r[4] for r in own}) == 3
    for a, b in zip(own, want, strict=True):
        assert a[:2] == b[:2] and a[4] == b[4] and np.allclose(a[2], b[2], atol=1e-12) and np.allclose(a[3], b[3], atol=1e-12)


def test_equal_rows_are_one_cell(spark, points, monkeypatch):
    """Rows of equal label and bins, put together or not, give the same trees; one of them is most of the rows."""
    many = points.unionByName(points.withColumn("key", F.col("key") + 600)).unionByName(
        points.where("key = 3").select(F.explode(F.sequence(F.lit(2000), F.lit(2900))).alias("key"), "label", "x"))
    g = grow.Growth(14, 4, min_leaf=3, min_split=8, balanced=True, features=2)
    alone = table(grow.grow_forest(many, "key", "label", "x", 3, 3, g))
    monkeypatch.setattr(grow, "FEW_ROWS", 0)
    blocks = []
    monkeypatch.setattr(grow, "grow_whole", lambda b, *rest, whole=grow.grow_whole: blocks.extend(b.where("part = 0").collect()) or whole(b, *rest))
    together = table(grow.grow_forest(many, "key", "label", "x", 3, 3, g))
    assert together == alone and len({t[0] for t in alone}) == 14
    cells = [len(r["labels"]) // 4 for r in blocks]
    assert sum(cells) < 1200 and sum(map(len, (r["rows"] for r in blocks))) == sum(map(len, (r["copies"] for r in blocks)))


def test_copies_of_blocks_are_those_of_the_bags(spark, points):
    cells = points.select("key", F.col("label").cast("int").alias("label"), F.array(*[F.lit(i).cast("tinyint") for i in range(3)]).alias("bins")).where("key < 40").coalesce(1).orderBy("key")
    want = {(r["tree"], r["key"]): r["copies"] for r in grow.bags(points.where("key < 40"), "key", 0, 13, 42).collect()}
    blocks = grow.bag_blocks(cells, 13, 42, 3, False).collect()
    own = {}
    for r in blocks:
        for i, copies in enumerate(np.frombuffer(r["copies"], r["kind"]).reshape(-1, 40)):
            own |= {(r["part"] * grow.TASK_TREES + i, key): int(c) for key, c in enumerate(copies) if c}
    assert own == want and len(blocks) == 2


def test_scenarios_of_a_table_forest_are_those_of_the_native_one(spark, monkeypatch):
    """Day averages of a grown preset: each different cell and its day variants are scored once, here against the walked native trees."""
    rng = np.random.default_rng(8)
    days = ["Monday", "Tuesday", "Sunday"]  # four days are unseen
    rows = [(i, "abc"[int(x > 0.4) + int(h > 15 and d == 2)], int(h), float(x), float(y), days[d]) for i, (h, x, y, d) in enumerate(
        zip(rng.integers(0, 24, 400), rng.random(400), rng.random(400), rng.integers(0, 3, 400), strict=True))]
    df = spark.createDataFrame(rows, "key long, category string, hour int, lat double, lon double, day string")
    preset = ml.ForestPreset(7, 6, min_instances=2, balanced=True, min_split=4, grown=True)
    res = ml.train_classifier(df, "category", "key", preset, numeric=("hour", "lat", "lon"), categorical=("day",))
    forest = res.model.stages[-1]
    assert isinstance(forest, trees.TableForest) and res.ready and res.accuracy > 0.7
    template = ml.forest(ml.ForestPreset(7, 0)).fit(ml.PipelineModel(res.model.stages[:-1]).transform(df).select("label", "features"))
    native_model = ml.PipelineModel([*res.model.stages[:-1], trees.as_model(trees.node_table(forest.packed, forest.cuts, 3), template)])
    points = df.select("key", "hour", "lat", "lon").where("key < 60")
    points = points.unionByName(points.where("key < 5"))
    weights = {"Monday": 2.0, "Sunday": 1.0, "Friday": 0.5}
    for top in (None, 2):
        own, want = (predict.score_scenarios(m, res.classes, points, "key", weights=weights, top=top) for m in (res.model, native_model))
        for a, b in zip(own, want, strict=True):
            a, b = (sorted(map(tuple, t.collect()), key=lambda r: (r[0], r[-1] if len(r) == 4 else 0, r[1])) for t in (a, b))
            assert len(a) == len(b) == 65 * (1 if len(a[0]) == 3 else top or 3)
            for x, y in zip(a, b, strict=True):
                assert [v for v in x if not isinstance(v, float)] == [v for v in y if not isinstance(v, float)]
                assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], abs=1e-12)
    own, want = (predict.score_scenarios(m, res.classes, points, "key")[1].groupBy("class").agg(F.sum("probability")).collect() for m in (res.model, native_model))
    assert dict(own) == pytest.approx(dict(want))
