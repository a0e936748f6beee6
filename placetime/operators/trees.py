"""Fitted forests as tables of nodes: probabilities as a column expression or
for a block of rows, importances from gains, and native models made from such a table.

A node table has one row per node: tree, node (0 is the root, children follow
their parent), feature and threshold (feature -1: a leaf), ``categories`` (values
that go left, for a categorical slot), left, right, gain, and ``weights`` (the
weight of each class in the node).

A packed tree is one row with the arrays of its nodes as bytes; nodes lie level by
level, so the children of the n-th inner node are nodes 2n + 1 and 2n + 2.  A
``TableForest`` is a fitted forest of packed trees: it stays in a table, and rows
are scored by tasks that each hold some of the trees.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.base import Transformer
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from .joins import shuffle_partitions

# Tasks get this module's functions with the job, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows whose votes are added at once: they stay in a core's cache.
VOTE_ROWS = 512
#: Rows of features, and nodes, that a task holds when it scores with packed trees.
SCORE_ROWS, SCORE_NODES = 1 << 18, 1 << 22

_SAVED = ("treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint, gain:double, "
          "leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>")


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """The node table of a fitted forest, read from its saved form."""
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    model.write().save(path)
    n = F.col("nodeData")
    split = n["split"]
    ordered = split["numCategories"] < 0
    return spark.read.schema(_SAVED).parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when(ordered, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~ordered, F.transform(split["leftCategoriesOrThreshold"], lambda c: c.cast("int"))).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["gain"].alias("gain"), n["impurityStats"].alias("weights"))


_PACKED = "array<array<struct<node:int, feature:int, threshold:double, categories:array<int>, left:int, right:int, share:array<double>>>>"


def packed_trees(nodes: DataFrame) -> Column:
    """A constant: an array per tree of its nodes in order, each leaf with its class shares.

    The nodes pass through the driver, as those of every native forest do.
    """
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    share = F.when(F.col("feature") < 0, F.transform("weights", lambda w: F.coalesce(F.try_divide(w, total), F.lit(0.0))))
    node = F.struct("node", "feature", "threshold", "categories", "left", "right", share.alias("share"))
    per_tree = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    text = per_tree.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"])).alias("j")).first()["j"]
    return F.from_json(F.lit(text), _PACKED)


def _leaf(tree: Column, features: Column, steps: Column) -> Column:
    """Place of the leaf that a row of features reaches in one tree."""
    def down(at: Column, _: Column) -> Column:
        n = F.get(tree, at)
        value = F.get(features, n["feature"])
        left = F.coalesce(F.array_contains(n["categories"], value.cast("int")), value <= n["threshold"])
        return F.when(n["feature"] < 0, at).when(left, n["left"]).otherwise(n["right"])

    return F.aggregate(steps, F.lit(0), down)


def forest_probability(nodes: DataFrame, features: str, depth: int) -> Column:
    """Class probabilities (array<double>) of a row: the mean over trees of its leaf's class shares.

    The whole forest is one constant and the expression only walks it, so
    generated code does not grow with the trees.
    ``features`` names an array<double> column; ``depth`` bounds the path length.
    """
    steps = F.array_repeat(F.lit(0), int(depth))
    shares = F.transform(packed_trees(nodes), lambda t: F.get(t, _leaf(t, F.col(features), steps))["share"])
    first = F.get(shares, F.lit(0))
    added = F.aggregate(F.slice(shares, F.lit(2), F.size(shares)), first, lambda a, s: F.zip_with(a, s, lambda x, y: x + y))
    return F.transform(F.array(added), lambda sums: F.transform(sums, lambda x: x / F.aggregate(sums, F.lit(0.0), lambda a, y: a + y)))[0]


@dataclass(frozen=True)
class FlatForest:
    """A forest's nodes as arrays, tree after tree; a leaf is its own child."""

    roots: np.ndarray  # place of each tree's root
    depths: np.ndarray  # steps to each tree's deepest leaf
    feature: np.ndarray
    above: np.ndarray | None  # left: above < value <= upto (None: no lower bounds)
    upto: np.ndarray
    child: np.ndarray  # left and right of each place
    leaf: np.ndarray  # row of a leaf in ``shares``
    shares: np.ndarray  # class shares of each leaf
    met: dict[int, np.ndarray]  # for some features, whether the path to a leaf splits them


def flat_forest(nodes: DataFrame, slots: Sequence[int | None] = ()) -> FlatForest:
    """The nodes as arrays, ``met`` for ``slots``; they pass through the driver, as those of every native forest do.

    Values that go left at a categorical slot must be a run of integers, as those of a one-hot slot are.
    """
    low, high = F.array_min("categories"), F.array_max("categories")
    held = nodes.select("tree", "node", "feature", "left", "right", "weights",
                        F.coalesce(low - F.lit(0.5), F.lit(float("-inf"))).alias("above"), F.coalesce(high + F.lit(0.5), "threshold").alias("upto"),
                        F.coalesce(high - low + 1 == F.size(F.array_distinct("categories")), F.lit(True)).alias("run")).toArrow()
    col = {c: held[c].to_numpy() for c in ("tree", "node", "feature", "left", "right", "above", "upto", "run")}
    if not col["run"].all():
        raise ValueError("values that go left at a categorical slot are not a run")
    order = np.lexsort((col["node"], col["tree"]))
    tree, feature, left, right, above, upto = (col[c][order] for c in ("tree", "feature", "left", "right", "above", "upto"))
    place = np.arange(len(order))
    roots = np.flatnonzero(np.diff(tree, prepend=-1))
    tree = np.cumsum(np.diff(tree, prepend=-1) != 0) - 1
    inner = feature >= 0
    child = np.stack([np.where(inner, roots[tree] + side, place) for side in (left, right)], axis=1)
    depths, at = np.zeros(len(roots), np.int64), roots
    met = {slot: np.zeros(len(order), bool) for slot in slots if slot is not None}
    while len(at := at[inner[at]]):
        depths[np.unique(tree[at])] += 1
        for slot, on_path in met.items():
            on_path[child[at]] = (on_path[at] | (feature[at] == slot))[:, None]
        at = child[at].ravel()
    weights = held["weights"].combine_chunks().flatten().to_numpy().reshape(len(order), -1)[order[~inner]]
    total = np.cumsum(weights, axis=1)[:, -1:]
    shares = np.divide(weights, total, out=np.zeros_like(weights), where=total != 0)
    return FlatForest(roots, depths, np.where(inner, feature, 0), above if np.isfinite(above).any() else None, np.where(inner, upto, np.inf),
                      child.ravel(), np.cumsum(~inner) - 1, shares, {slot: on_path[~inner] for slot, on_path in met.items()})


def leaf_rows(forest: FlatForest, x: np.ndarray, tree: int) -> np.ndarray:
    """Row in ``shares`` of the leaf that each row of features reaches in one tree."""
    values, first = x.ravel(), np.arange(len(x)) * x.shape[1]
    at = np.full(len(x), forest.roots[tree])
    for _ in range(forest.depths[tree]):
        v = values.take(first + forest.feature.take(at))
        left = v <= forest.upto.take(at)
        if forest.above is not None:
            left &= v > forest.above.take(at)
        at = forest.child.take(2 * at + ~left)
    return forest.leaf.take(at)


def mean_probability(forest: FlatForest, x: np.ndarray, slots: Sequence[int | None], weights: Sequence[float]) -> np.ndarray:
    """Class probabilities of each row, averaged over variants of it that have 1 in one slot (None: the row itself).

    A tree is walked again only for the rows whose own path splits the slot.  Votes, shares and variants are added in the
    native forest's order, so results equal its own to the last bit.
    """
    trees = range(len(forest.roots))
    found = {(t, None): leaf_rows(forest, x, t) for t in trees}
    for slot in {*slots} - {None}:
        for t in trees:
            other = np.flatnonzero(forest.met[slot].take(found[t, None]))
            if len(other):
                seen = x[other]
                seen[:, slot] = 1.0
                found[t, slot] = found[t, None].copy()
                found[t, slot][other] = leaf_rows(forest, seen, t)
    mean = np.zeros((len(x), forest.shares.shape[1]))
    for lo in range(0, len(x), VOTE_ROWS):
        sums = mean[lo : lo + VOTE_ROWS]
        held = np.empty_like(sums)
        for slot, weight in zip(slots, weights, strict=True):
            votes = np.zeros_like(sums)
            for t in trees:
                leaf = found.get((t, slot), found[t, None])[lo : lo + VOTE_ROWS]
                votes += np.take(forest.shares, leaf, axis=0, out=held, mode="clip")
            total = np.cumsum(votes, axis=1)[:, -1:]
            np.divide(votes, total, out=votes, where=total != 0)
            votes *= weight
            sums += votes
    mean /= np.cumsum(weights)[-1]
    return mean


def gain_importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): each tree's gains times node weight, shared out to 1 per tree, then over the forest."""
    weight = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    gains = nodes.where(F.col("feature") >= 0).groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("g"))
    total = gains.groupBy("tree").agg(F.sum("g").alias("t"))
    shares = gains.join(total, "tree").groupBy("feature").agg(F.sum(F.try_divide("g", "t")).alias("s"))
    return shares.select("feature", F.try_divide("s", shares.agg(F.sum("s")).scalar()).alias("importance"))


def as_model(nodes: DataFrame, template: RandomForestClassificationModel) -> RandomForestClassificationModel:
    """A native forest of a node table.

    ``template`` is any fitted forest with as many trees over the same features
    and classes; its saved form is kept but for the nodes.  The model is held by
    the driver, as every native forest is.
    """
    spark = nodes.sparkSession
    path = scratch_path(spark, f"grown-{uuid.uuid4().hex}")
    template.write().save(path)
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    squares = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w * w)
    impurity = F.coalesce(F.lit(1.0) - F.try_divide(squares, total * total), F.lit(0.0))
    inner = F.col("feature") >= 0
    threshold = F.when(inner, F.array(F.col("threshold"))).otherwise(F.array().cast("array<double>"))
    split = F.struct(F.when(inner, F.col("feature")).otherwise(-1).alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    place = lambda c: F.when(inner, F.col(c)).otherwise(-1).cast("int")
    node = F.struct(F.col("node").cast("int").alias("id"), (F.array_position("weights", F.array_max("weights")) - 1).cast("double").alias("prediction"),
                    impurity.alias("impurity"), F.col("weights").alias("impurityStats"), F.col("rows").cast("long").alias("rawCount"),
                    F.when(inner, F.col("gain")).otherwise(-1.0).alias("gain"), place("left").alias("leftChild"), place("right").alias("rightChild"), split.alias("split"))
    nodes.select(F.col("tree").cast("int").alias("treeID"), node.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


PACKED = ("tree int, features binary, bins binary, kind string, leaves binary, rows binary, scale array<double>, importance array<double>")


def pack_tree(tree: int, feature: np.ndarray, bin_: np.ndarray, gain: np.ndarray, counts: np.ndarray, rows: np.ndarray, scale: np.ndarray, width: int) -> pa.RecordBatch:
    """A packed tree of its nodes in the order of levels; ``scale`` is what a count of each class weighs."""
    inner = feature >= 0
    gains = gain[inner] * (counts[inner] @ scale)
    importance = np.bincount(feature[inner], gains, width)
    leaves = counts[~inner]
    if (leaves == np.floor(leaves)).all():
        leaves = leaves.astype(np.min_scalar_type(int(leaves.max())))
    held = [feature.astype(np.int16), np.where(inner, bin_, 0).astype(np.uint8), leaves, rows[~inner].astype(np.int64)]
    held = [pa.array([v.tobytes()], pa.binary()) for v in held]
    return pa.RecordBatch.from_arrays(
        [pa.array([tree], pa.int32()), *held[:2], pa.array([leaves.dtype.str]), *held[2:], *[pa.array([v.tolist()], pa.list_(pa.float64())) for v in (scale, importance)]],
        ["tree", "features", "bins", "kind", "leaves", "rows", "scale", "importance"])


def packed_tables(found: DataFrame, width: int) -> DataFrame:
    """Packed trees of nodes (tree, node by its place in the complete tree, f, b, gain, weights, rows)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        weights = rows["weights"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        f, b = (rows[c].fill_null(-1).to_numpy() for c in ("f", "b"))
        packed = pack_tree(rows["tree"][0].as_py(), f, b, rows["gain"].fill_null(-1.0).to_numpy(), weights, rows["rows"].to_numpy(), np.ones(weights.shape[1]), width)
        return pa.Table.from_batches([packed])

    return found.groupBy("tree").applyInArrow(run, PACKED)


def _children(feature: np.ndarray) -> np.ndarray:
    """Place of the left child of each node of a packed tree; the right one is next.  A leaf has its own place."""
    inner = feature >= 0
    return np.where(inner, 2 * np.cumsum(inner) - 1, np.arange(len(feature)))


def _node_arrays(features: bytes, bins: bytes, kind: str, leaves: bytes, scale: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and bin of each node, and the weights of each leaf."""
    scale = np.asarray(scale, np.float64)
    return np.frombuffer(features, np.int16), np.frombuffer(bins, np.uint8), np.frombuffer(leaves, kind).reshape(-1, len(scale)) * scale


def node_table(packed: DataFrame, cuts: Sequence[Sequence[float]], classes: int) -> DataFrame:
    """The node table of packed trees."""
    schema = "tree int, node int, feature int, threshold double, left int, right int, gain double, weights array<double>, rows long, categories array<int>"
    at_cut = np.full((len(cuts), max([1, *map(len, cuts)])), np.nan)
    for f, own in enumerate(cuts):
        at_cut[f, : len(own)] = own

    def run(batches):
        for batch in batches:
            for tree, features, bins, kind, leaves, rows, scale in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                feature, bin_, held = _node_arrays(features, bins, kind, leaves, scale)
                inner, left = feature >= 0, _children(feature)
                weights, n = np.zeros((len(feature), classes)), np.zeros(len(feature), np.int64)
                weights[~inner], n[~inner] = held, np.frombuffer(rows, np.int64)
                ends = [0, 1]  # of the levels
                while ends[-1] < len(feature):
                    ends.append(ends[-1] + 2 * int(inner[ends[-2] : ends[-1]].sum()))
                for lo, hi in zip(ends[-2::-1], ends[:0:-1], strict=True):
                    at = lo + np.flatnonzero(inner[lo:hi])
                    weights[at] = weights[left[at]] + weights[left[at] + 1]
                    n[at] = n[left[at]] + n[left[at] + 1]
                of = np.flatnonzero(inner)
                total, squares = weights.sum(1), (weights**2).sum(1)
                gain = np.full(len(feature), -1.0)
                gain[of] = (squares[left[of]] / total[left[of]] + squares[left[of] + 1] / total[left[of] + 1] - squares[of] / total[of]) / total[of]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, weights.size + 1, classes), pa.int32()), pa.array(weights.ravel()))
                many = len(feature)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(many, tree), pa.int32()), pa.array(np.arange(many), pa.int32()), pa.array(feature, pa.int32()),
                     pa.array(at_cut[np.maximum(feature, 0), np.where(inner, bin_, 0)], mask=~inner), *[pa.array(np.where(inner, v, -1), pa.int32()) for v in (left, left + 1)],
                     pa.array(gain), lists, pa.array(n), pa.nulls(many, pa.list_(pa.int32()))],
                    ["tree", "node", "feature", "threshold", "left", "right", "gain", "weights", "rows", "categories"])

    return packed.mapInArrow(run, schema)


def bin_values(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """The number of cuts below each value of rows of features (NaN is above all)."""
    bins = np.empty(x.shape, np.uint8)
    for f, own in enumerate(cuts):
        bins[:, f] = np.searchsorted(np.asarray(own, np.float64), x[:, f])
    return bins


def _binary(held: np.ndarray) -> pa.Array:
    """Each row of bytes as a binary value."""
    n, width = held.shape
    offsets = pa.py_buffer(np.arange(0, n * width + 1, width, dtype=np.int32)) if width else pa.py_buffer(np.zeros(n + 1, np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(held))])


def add_votes(votes: np.ndarray, cells: np.ndarray, feature: np.ndarray, bin_: np.ndarray, leaves: np.ndarray) -> None:
    """Add to each row of bins the class shares of the leaf that it reaches in a packed tree."""
    inner = feature >= 0
    left, own, upto = _children(feature), np.where(inner, feature, 0).astype(np.int64), np.where(inner, bin_, 255).astype(np.uint8)
    total = leaves.sum(1, keepdims=True)
    shares = np.divide(leaves, total, out=np.zeros_like(leaves), where=total != 0)
    leaf = np.cumsum(~inner) - 1
    values, first = cells.ravel(), np.arange(len(cells)) * cells.shape[1]
    at = np.zeros(len(cells), np.int64)
    while True:
        below = left.take(at) + (values.take(first + own.take(at)) > upto.take(at))
        if (below == at).all():
            break
        at = below
    votes += shares.take(leaf.take(at), axis=0)


class TableForest(Transformer):
    """A fitted forest whose packed trees stay in a table.

    Rows whose features have the same bins reach the same leaves, so different bins (cells) are scored, once each.  A task
    takes some of the trees and some of the cells; the votes of all trees for a cell are then added in the trees' order.
    """

    def __init__(self, packed: DataFrame, cuts: Sequence[Sequence[float]], classes: int, features: str = "features"):
        super().__init__()
        self.packed, self.cuts, self.numClasses, self._features = packed, [list(c) for c in cuts], classes, features
        # A row per tree.
        rows = packed.select("tree", F.octet_length("features").alias("n"), "importance").collect()
        self.treeNodes = {r["tree"]: r["n"] // 2 for r in rows}
        gains = np.array([r["importance"] for r in sorted(rows, key=lambda r: r["tree"])]).reshape(len(rows), -1)
        total = gains.sum(1, keepdims=True)
        shares = np.divide(gains, total, out=np.zeros_like(gains), where=total > 0).sum(0)
        self.featureImportances = DenseVector(shares / shares.sum() if shares.sum() > 0 else shares)

    @property
    def getNumTrees(self) -> int:
        return len(self.treeNodes)

    @property
    def totalNumNodes(self) -> int:
        return sum(self.treeNodes.values())

    @property
    def numFeatures(self) -> int:
        return len(self.cuts)

    def getFeaturesCol(self) -> str:
        return self._features

    def cell(self, features: Column) -> Column:
        """The bins of an array of features, as bytes."""
        cuts = self.cuts

        @F.arrow_udf("binary")
        def binned(x: pa.Array) -> pa.Array:
            return _binary(bin_values(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts)), cuts))

        return binned(features)

    def with_slot(self, cell: Column, slot: int, value: float) -> Column:
        """The cell with another value of one feature."""
        own = int(bin_values(np.full((1, 1), value), [self.cuts[slot]])[0, 0])
        return F.concat(F.substring(cell, 1, slot), F.lit(bytes([own])), F.substring(cell, slot + 2, self.numFeatures))

    def votes(self, cells: DataFrame) -> DataFrame:
        """(cell, votes): the summed class shares of each different cell of the one column of ``cells``; a written table."""
        spark, width, classes = cells.sparkSession, self.numFeatures, self.numClasses
        column = F.col(cells.columns[0])
        paths = [scratch_path(spark, f"{name}-{uuid.uuid4().hex}") for name in ("cells", "votes")]
        cells.select(column.alias("cell")).where("cell IS NOT NULL").distinct().write.parquet(paths[0])
        cells = spark.read.schema("cell binary").parquet(paths[0])
        chunks = -(-cells.count() // SCORE_ROWS) or 1
        parts = shuffle_partitions(cells)
        groups = max(1, min(self.getNumTrees, max(-(-parts // chunks), -(-self.totalNumNodes // SCORE_NODES))))
        schema = "block long, tree int, features binary, bins binary, kind string, leaves binary, scale array<double>"

        def blocks(batches):
            for k, batch in enumerate(b for b in batches if b.num_rows):
                number = (TaskContext.get().partitionId() << 32) + k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.nulls(1, pa.int32()), pa.array([b"".join(batch.column(0).to_pylist())], pa.binary()),
                     *[pa.nulls(1, t) for t in (pa.binary(), pa.string(), pa.binary(), pa.list_(pa.float64()))]],
                    ["block", "tree", "features", "bins", "kind", "leaves", "scale"])

        def score(batches):
            held, trees = {}, []
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True)
                for part, block, tree, features, *arrays in rows:
                    if tree is None:
                        held[block] = np.frombuffer(features, np.uint8).reshape(-1, width)
                    else:
                        trees.append((tree, features, *arrays))
            if not held or not trees:
                return
            names, x = sorted(held), np.concatenate([held[b] for b in sorted(held)])
            sums = np.zeros((len(x), classes))
            trees.sort(key=lambda t: t[0])
            for _, *arrays in trees:
                add_votes(sums, x, *_node_arrays(*arrays))
            lo = 0
            for block in names:
                hi = lo + len(held[block])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part % groups], pa.int32()), pa.array([held[block].tobytes()], pa.binary()),
                                                  pa.array([sums[lo:hi].tobytes()], pa.binary())], ["block", "part", "cells", "sums"])
                lo = hi

        def add(batches):
            held: dict[int, list] = {}
            for batch in batches:
                for block, part, cells, sums in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                    held.setdefault(block, []).append((part, cells, sums))
                    if len(held[block]) == groups:
                        found = sorted(held.pop(block))
                        total = sum((np.frombuffer(s, np.float64) for _, _, s in found[1:]), np.frombuffer(found[0][2], np.float64))
                        total = total.reshape(-1, classes)
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, classes), pa.int32()), pa.array(total.ravel()))
                        yield pa.RecordBatch.from_arrays([_binary(np.frombuffer(found[0][1], np.uint8).reshape(-1, width)), lists], ["cell", "votes"])
            if held:
                raise ValueError("votes of some trees are missing")

        # Each block of cells meets each group of trees in one task: task = chunk of cells * groups + group of trees.
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        placed = cells.mapInArrow(blocks, schema).select("*", F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("_c"), every(groups).alias("_g"))
        # Trees are dealt by their rank, since a tree without rows in its bag is absent.
        dealt = spark.createDataFrame([(t, i % groups) for i, t in enumerate(sorted(self.treeNodes))], "tree int, _g int")
        grown = self.packed.join(F.broadcast(dealt), "tree").withColumn("block", F.lit(None).cast("long")).withColumn("_c", every(chunks))
        both = placed.unionByName(grown.select(*placed.columns)).withColumn("part", (F.col("_c") * groups + F.col("_g")).cast("int"))
        both = both.select("part", "block", "tree", "features", "bins", "kind", "leaves", "scale")
        partial = both.repartitionById(chunks * groups, F.col("part")).mapInArrow(score, "block long, part int, cells binary, sums binary")
        partial.repartition(parts, "block").mapInArrow(add, "cell binary, votes array<double>").write.parquet(paths[1])
        delete_path(spark, paths[0])
        return spark.read.schema("cell binary, votes array<double>").parquet(paths[1])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds rawPrediction, probability and prediction; the cells are scored at once, by a job."""
        rows = dataset.withColumn("_cell", self.cell(vector_to_array(self._features)))
        votes = self.votes(rows.select("_cell")).withColumnsRenamed({"cell": "_cell", "votes": "_votes"})
        out = rows.join(votes, "_cell", "left")
        p = shares("_votes")
        return out.select(*dataset.columns, array_to_vector("_votes").alias("rawPrediction"), array_to_vector(p).alias("probability"),
                          (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"))


def shares(votes: str) -> Column:
    """Class probabilities of summed votes."""
    return F.transform(F.array(votes), lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda a, y: a + y)))[0]
