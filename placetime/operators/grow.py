"""Random forests grown level by level as aggregates, for presets that need
weights per tree and deep trees.

Every tree draws its bag by key: a row's copies in a tree are a Poisson(1) draw
of (seed, tree, key), so a bag does not depend on partitioning or retries.  With
``balanced`` a class weighs n / (classes * n_class) of the tree's own bag.

Trees grow together in groups.  Between levels a table keeps, for each row in
each tree's bag, the node that it is in; a level counts the weights of (tree,
node, feature, bin, class) over a keyed choice of features per node, turns the
counts into the best Gini split of each node with running sums, and sends the
rows on to the children.  A node that no more than ``FINISH_ROWS`` rows reach
leaves the table: its subtree is grown in one task, from that bounded number of
rows, by the same rule.  So the depth of the trees costs no passes over all
rows, and no larger node is ever gathered.  Features are cut into bins at
quantiles of a bounded keyed sample.

Rows of equal bins and label are one cell: no tree tells them apart.  Where the
cells of all rows fit one task, levels need no tables: tasks get each tree's copies
and rows of every cell, as bytes, and grow whole trees.
"""

from __future__ import annotations

import math
import sys
import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import KeyedDigests, keyed_uniform_sql
from ..session import delete_path, scratch_path
from .joins import settle_bounded, shuffle_partitions
from .trees import PACKED, node_table, pack_tree, packed_tables

# Tasks get this module's functions with the job, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins per feature, rows of the sample their cuts are taken from, and trees that grow together.
BINS, SAMPLE_ROWS, GROUP_TREES = 32, 20_000, 100
#: Rows of a node whose subtree is grown in one task; whole trees are grown there from up to twice as many cells.
FINISH_ROWS = 1 << 20
#: Trees of a task that grows whole trees, and counts of (class, cell) that it holds at once.
TASK_TREES, HELD_COUNTS = 12, 1 << 20
#: Rows up to which equal ones are not looked for.
FEW_ROWS = 1 << 14
_LEAF, _SMALL, _LARGE = 0, 1, 2
_FOUND = "tree int, node long, f int, b int, gain double, weights array<double>, rows long"
#: Running sums of Poisson(1): a draw at or above the n-th has more than n copies.
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(n + 1)) for n in range(12)]


@dataclass(frozen=True)
class Growth:
    trees: int
    depth: int
    min_leaf: int = 1
    min_split: int = 2
    balanced: bool = False
    seed: int = 42
    features: int | None = None  # tried per node; None: the root of their number


def bags(rows: DataFrame, key: str, first: int, last: int, seed: int) -> DataFrame:
    """The rows once per tree (``first`` to ``last`` - 1) that drew them, with ``copies``."""
    draws = ", ".join(keyed_uniform_sql(f"bag{seed}-{t // 4}", key, t % 4) for t in range(first, last))
    cuts = ", ".join(f"{p!r}D" for p in POISSON)
    drawn = rows.selectExpr("*", f"posexplode(transform(array({draws}), u -> size(filter(array({cuts}), p -> u >= p)))) AS (_t, copies)")
    return drawn.where("copies > 0").withColumn("tree", F.col("_t") + F.lit(first)).drop("_t")


def bag_weights(bag: DataFrame, label: str, balanced: bool) -> DataFrame:
    """(tree, label, n, weight): copies of each class in each bag and what one of them weighs."""
    sizes = bag.groupBy("tree", label).agg(F.sum("copies").alias("n"))
    if not balanced:
        return sizes.withColumn("weight", F.lit(1.0))
    whole = sizes.groupBy("tree").agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return sizes.join(whole, "tree").select("tree", label, "n", (F.col("_all") / (F.col("_k") * F.col("n"))).alias("weight"))


def feature_cuts(rows: DataFrame, key: str, features: str, width: int, seed: int) -> list[list[float]]:
    """Ascending cuts of each feature: at most ``BINS`` - 1 quantiles of a keyed sample."""
    n = rows.count()
    draw = F.expr(keyed_uniform_sql(f"cuts{seed}", key))
    sample = rows if n <= SAMPLE_ROWS else rows.where(draw < F.lit(SAMPLE_ROWS / n))
    shares = [k / BINS for k in range(1, BINS)]
    values = [F.percentile_approx(F.get(features, F.lit(i)), shares, SAMPLE_ROWS).alias(f"c{i}") for i in range(width)]
    row = sample.agg(*values).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(width)]


def _constant(cuts: list[list[float]]) -> str:
    return "array(" + ", ".join("array(" + (", ".join(f"{c!r}D" for c in own) or "CAST(NULL AS DOUBLE)") + ")" for own in cuts) + ")"


def _binned(features: str, cuts: list[list[float]]) -> Column:
    """The number of cuts below each feature's value."""
    return F.expr(f"transform(zip_with({features}, {_constant(cuts)}, (v, cuts) -> named_struct('v', v, 'cuts', cuts)), "
                  "p -> CAST(size(filter(p.cuts, c -> c < p.v)) AS TINYINT))")


def best_splits(active: DataFrame, chosen: int, width: int, g: Growth) -> DataFrame:
    """The best split of each node of ``active`` (tree, node, label, bins, w): feature, bin, gain and what goes left and right.

    With T the weight of a class in the node and L that left of a cut, the squares
    of L and of T - L change by closed terms at each cell, so running sums give
    the Gini gain of every cut.  Nodes without a cut that leaves ``min_leaf`` rows
    on both sides and gains are absent.
    """
    draws = f"array_sort(transform(sequence(0, {width - 1}), f -> named_struct('h', xxhash64({g.seed}, tree, node, f), 'f', f)))"
    cells = active.selectExpr("tree", "node", "label", "w", f"inline(transform(slice({draws}, 1, {chosen}), d -> named_struct('f', d.f, 'b', bins[d.f])))")
    cells = cells.groupBy("tree", "node", "f", "b", "label").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("c"))
    of_class = "PARTITION BY tree, node, f, label"
    cells = cells.selectExpr("tree", "node", "f", "b", "w", "c", f"sum(w) OVER ({of_class}) AS t", f"sum(w) OVER ({of_class} ORDER BY b) - w AS l")
    at = cells.groupBy("tree", "node", "f", "b").agg(F.expr("sum((l + w) * (l + w) - l * l)").alias("up"), F.expr("sum((t - l - w) * (t - l - w) - (t - l) * (t - l))").alias("down"),
                                                     F.sum("w").alias("w"), F.sum("c").alias("c"))
    of_feature, so_far = "PARTITION BY tree, node, f", "PARTITION BY tree, node, f ORDER BY b"
    sums = at.selectExpr("tree", "node", "f", "b", f"sum(up) OVER ({so_far}) AS left_squares", f"sum(up) OVER ({of_feature}) AS squares",
                         f"sum(down) OVER ({so_far}) AS fall", f"sum(w) OVER ({so_far}) AS left_w", f"sum(w) OVER ({of_feature}) AS all_w",
                         f"sum(c) OVER ({so_far}) AS left_n", f"sum(c) OVER ({of_feature}) AS all_n")
    cuts = sums.where((F.col("left_n") >= g.min_leaf) & (F.col("all_n") - F.col("left_n") >= g.min_leaf)).selectExpr(
        "*", "squares + fall AS right_squares", "all_w - left_w AS right_w")
    gain = "(left_squares / left_w + right_squares / right_w - squares / all_w) / all_w"
    best = cuts.groupBy("tree", "node").agg(F.expr(f"max_by(struct(f, b, {gain} AS gain, left_squares, left_w, left_n, right_squares, right_w, all_n - left_n AS right_n), "
                                                   f"struct({gain}, -f, -b))").alias("s"))
    return best.select("tree", "node", "s.*").where(F.col("gain") > 1e-12)


def _level(active: DataFrame, splits: DataFrame, depth: int, g: Growth) -> DataFrame:
    """Rows of split nodes in their children, with the child's ``state``."""
    def state(side: str) -> Column:
        pure = F.col(f"{side}_squares") >= F.col(f"{side}_w") * F.col(f"{side}_w") * (1 - 1e-12)
        done = F.lit(depth + 1 >= g.depth) | pure | (F.col(f"{side}_n") < g.min_split)
        return F.when(done, _LEAF).when(F.col(f"{side}_n") <= FINISH_ROWS, _SMALL).otherwise(_LARGE)

    goes_left = F.get("bins", F.col("f")) <= F.col("b")
    child = 2 * F.col("node") + F.when(goes_left, 1).otherwise(2)
    return active.join(splits, ["tree", "node"]).select("tree", child.alias("node"), "label", "bins", "w", "copies", F.when(goes_left, state("left")).otherwise(state("right")).alias("state"))


def _drawn_features(nodes: np.ndarray, tree: int, chosen: int, width: int, seed: int) -> np.ndarray:
    """The features each node tries, ascending: those of the least keyed hashes (splitmix64)."""
    z = nodes.astype(np.uint64)[:, None] * np.uint64(width) + np.arange(width, dtype=np.uint64)
    for salt in (seed % (1 << 63), tree):
        z = (z ^ np.uint64(salt)) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    # The number of the feature takes the lowest bits of its hash.
    low = np.uint64((1 << (width - 1).bit_length()) - 1)
    z = (z & ~low) | np.arange(width, dtype=np.uint64)
    return np.sort((np.partition(z, chosen - 1, axis=1)[:, :chosen] & low).astype(np.int64), axis=1)


def _level_splits(group: np.ndarray, label: np.ndarray, bins: np.ndarray, w: np.ndarray, features: np.ndarray, classes: int, g: Growth,
                  scale: np.ndarray | None = None, sizes: np.ndarray | None = None, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best (feature or -1, bin, gain) of each node of a level, as ``best_splits`` has it.

    ``group`` numbers the nodes of the cells, ``w`` holds a cell's copies and ``rows`` its rows (None: one), ``scale``
    what a copy of a class weighs (None: 1), ``sizes`` the bins of each feature.  Copies are whole numbers, so running
    sums over all nodes are exact, and a node's are those less what came before it.
    """
    many, width = len(features), bins.shape[1]
    scale = np.ones(classes) if scale is None else scale
    sizes = np.full(width, BINS) if sizes is None else sizes
    best_f, best_b, best_gain = np.full(many, -1), np.zeros(many, np.int64), np.full(many, 1e-12)
    values, first = bins.ravel(), np.arange(len(group)) * width
    for j in range(features.shape[1]):
        f = features[:, j]
        size = sizes[f]
        end = np.cumsum(size)
        start, total = end - size, int(end[-1])
        cell = values.take(first + f.take(group, mode="clip"), mode="clip") + start.take(group, mode="clip")
        left = np.bincount(cell + label * total, w, classes * total).reshape(classes, total)
        left_n = np.bincount(cell, rows, total)
        for held in (left, left_n[None]):
            head = held[:, start]
            np.cumsum(held, axis=1, out=held)
            held -= np.repeat(held[:, start] - head, size, axis=1)
        all_n = left_n[end - 1]
        on = (left_n >= g.min_leaf) & (np.repeat(all_n, size) - left_n >= g.min_leaf)
        if not on.any():
            continue
        whole = left[:, end - 1]
        right = np.repeat(whole, size, axis=1)
        right -= left
        for side in (left, right, whole):
            side *= scale[:, None]
        squares = [np.einsum("ij,ij->j", side, side) for side in (left, right, whole)]
        all_w = whole.sum(0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = squares[0] / left.sum(0) + squares[1] / right.sum(0)
            gain -= np.repeat(squares[2] / all_w, size)
            gain /= np.repeat(all_w, size)
        gain[~on] = -np.inf
        top = np.maximum.reduceat(gain, start)
        found = np.flatnonzero(gain == np.repeat(top, size))[::-1]
        node = np.repeat(np.arange(many), size)[found]
        lowest = np.zeros(many, np.int64)
        lowest[node] = found - start[node]  # the lowest bin is assigned last
        better = top > best_gain
        best_f[better], best_b[better], best_gain[better] = f[better], lowest[better], top[better]
    return best_f, best_b, best_gain


def grow_tree(tree: int, root: int, label: np.ndarray, bins: np.ndarray, copies: np.ndarray, rows: np.ndarray | None, scale: np.ndarray, sizes: np.ndarray,
              chosen: int, g: Growth) -> list[tuple[np.ndarray, ...]]:
    """The levels below ``root``, each as (node, feature or -1, bin, gain, copies of each class, rows) of its nodes in order.

    The cells lie in the order of their nodes, and go to the children's places after each level.
    """
    classes, width = len(scale), bins.shape[1]
    copies = copies.astype(np.float64)
    at_once = max(1, HELD_COUNTS // (classes * BINS))
    nodes, group, levels = np.array([root], np.int64), np.zeros(len(label), np.int64), []
    while len(nodes):
        held = np.bincount(group * classes + label, copies, len(nodes) * classes).reshape(-1, classes)
        n = np.bincount(group, rows, len(nodes)).astype(np.int64)
        grows = (int(nodes[0] + 1).bit_length() - 1 < g.depth) & (n >= g.min_split) & ((held != 0).sum(1) > 1)
        f, b, gain = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.full(len(nodes), -1.0)
        ends = np.cumsum(np.bincount(group, minlength=len(nodes)))
        for lo in range(0, len(nodes), at_once):
            some = grows[lo : lo + at_once]
            if not some.any():
                continue
            part = slice(ends[lo - 1] if lo else 0, ends[min(lo + at_once, len(nodes)) - 1])
            own = group[part] - lo
            cells = (own, label[part], bins[part], copies[part], None if rows is None else rows[part])
            if not some.all():
                kept = np.flatnonzero(some.take(own))
                cells = tuple(None if v is None else v.take(kept, axis=0, mode="clip") for v in cells)
                cells = ((np.cumsum(some) - 1).take(cells[0]), *cells[1:])
            which = lo + np.flatnonzero(some)
            features = _drawn_features(nodes[which], tree, chosen, width, g.seed)
            found = _level_splits(cells[0], cells[1], cells[2], cells[3], features, classes, g, scale, sizes, cells[4])
            f[which], b[which] = found[:2]
            gain[which] = np.where(found[0] >= 0, found[2], -1.0)
        levels.append((nodes, f, b, gain, held, n))
        split = f >= 0
        nodes = np.stack([2 * nodes[split] + 1, 2 * nodes[split] + 2], axis=1).ravel()
        if not len(nodes):
            break
        # Cells of split nodes go left or right within their node's place.
        kept = np.flatnonzero(split.take(group))
        own = group.take(kept)
        goes_right = bins.ravel().take(kept * width + f.take(own, mode="clip"), mode="clip") > b.take(own, mode="clip")
        own = (np.cumsum(split) - 1).take(own, mode="clip")
        sides = np.bincount(2 * own + goes_right, minlength=len(nodes)).reshape(-1, 2)
        rights = np.cumsum(goes_right) - goes_right
        lefts_to, rights_before = np.cumsum(sides[:, 0]), np.cumsum(sides[:, 1]) - sides[:, 1]
        order = np.empty(len(kept), np.int64)
        order[np.where(goes_right, lefts_to.take(own, mode="clip") + rights, np.arange(len(kept)) - rights + rights_before.take(own, mode="clip"))] = kept
        label, copies, bins = label.take(order, mode="clip"), copies.take(order, mode="clip"), bins.take(order, axis=0, mode="clip")
        rows = None if rows is None else rows.take(order, mode="clip")
        group = np.repeat(np.arange(len(nodes)), sides.ravel())
    return levels


def finish(small: DataFrame, chosen: int, width: int, classes: int, g: Growth, sizes: np.ndarray) -> DataFrame:
    """The nodes of the subtrees under small nodes; a group has ``FINISH_ROWS`` rows at most."""
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("f", pa.int32()), ("b", pa.int32()), ("gain", pa.float64()),
                        ("weights", pa.list_(pa.float64())), ("rows", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        tree = rows["tree"][0].as_py()
        label, copies = rows["label"].to_numpy().astype(np.int64), rows["copies"].to_numpy()
        bins = rows["bins"].combine_chunks().flatten().to_numpy().reshape(len(label), width).astype(np.uint8)
        scale = np.ones(classes)
        scale[label] = rows["w"].to_numpy() / copies
        parts = []
        for nodes, f, b, gain, held, n in grow_tree(tree, rows["node"][0].as_py(), label, bins, copies, None, scale, sizes, chosen, g):
            weights = held * scale
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, weights.size + 1, classes), pa.int32()), pa.array(weights.ravel()))
            cut = [pa.array(v, t, mask=f < 0) for v, t in ((f, pa.int32()), (b, pa.int32()), (gain, pa.float64()))]
            parts.append(pa.Table.from_arrays([pa.array(np.full(len(nodes), tree), pa.int32()), pa.array(nodes), *cut, lists, pa.array(n, pa.int64())], schema=schema))
        return pa.concat_tables(parts)

    return small.select("tree", "node", "label", "bins", "w", "copies").groupBy("tree", "node").applyInArrow(run, _FOUND)


_BLOCK = "part int, labels binary, bins binary, kind string, copies binary, rows binary"


def bag_blocks(cells: DataFrame, trees: int, seed: int, width: int, merged: bool) -> DataFrame:
    """Labels and bins of the rows with their copies in each tree's bag (those of ``bags``), in blocks for each ``TASK_TREES`` trees.

    With ``merged`` equal rows next to each other are one cell, with its copies and the rows that were drawn.
    """
    text = F.coalesce(F.concat(F.lit("|"), F.col("key").cast("string")), F.lit("")).cast("binary")
    cuts = [np.uint32(c) for p in POISSON if (c := math.ceil(p * 2**32)) < 2**32]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label, bins = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(n, width).astype(np.uint8)
            digests = KeyedDigests(batch.column(2).to_pylist())
            copies, rows = np.zeros((4 * -(-trees // 4), n), np.uint8), None
            for t in range(0, trees, 4):  # a digest holds four draws
                u = digests.of(f"bag{seed}-{t // 4}".encode())
                for cut in cuts:
                    copies[t : t + 4] += u >= cut
            copies = copies[:trees]
            if merged:
                new = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (bins[1:] != bins[:-1]).any(1)))
                rows = np.add.reduceat(copies != 0, new, axis=1, dtype=np.uint32)
                copies = np.add.reduceat(copies, new, axis=1, dtype=np.uint32)
                label, bins = label[new], bins[new]
                if copies.max() < 256:
                    copies, rows = copies.astype(np.uint8), rows.astype(np.uint8)
            parts = range(0, trees, TASK_TREES)
            held = lambda v: [b"" if v is None else v[a : a + TASK_TREES].tobytes() for a in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), *[pa.array([v.tobytes()] * len(parts), pa.binary()) for v in (label.astype(np.int32), bins)],
                 pa.array([copies.dtype.str] * len(parts)), *[pa.array(held(v), pa.binary()) for v in (copies, rows)]],
                ["part", "labels", "bins", "kind", "copies", "rows"])

    return cells.select("label", "bins", text.alias("text")).mapInArrow(run, _BLOCK)


def grow_whole(blocks: DataFrame, sizes: np.ndarray, chosen: int, width: int, classes: int, g: Growth) -> DataFrame:
    """Whole trees (``trees.PACKED``), ``TASK_TREES`` to a task."""
    parts = -(-g.trees // TASK_TREES)

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for part, labels, bins, kind, copies, rows in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                drawn = [None if not v else np.frombuffer(v, kind).reshape(-1, len(labels) // 4) for v in (copies, rows)]
                held.setdefault(part, []).append((np.frombuffer(labels, np.int32), np.frombuffer(bins, np.uint8).reshape(-1, width), *drawn))
        for part in sorted(held):
            blocks = held.pop(part)
            label, bins = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
            for i in range(min(TASK_TREES, g.trees - part * TASK_TREES)):
                copies = np.concatenate([b[2][i] for b in blocks])
                on = np.flatnonzero(copies)
                if not len(on):
                    continue
                rows = None if blocks[0][3] is None else np.concatenate([b[3][i] for b in blocks])[on].astype(np.float64)
                own, copies = label[on].astype(np.int64), copies[on]
                scale = np.ones(classes)
                if g.balanced:
                    n = np.bincount(own, copies, classes)
                    scale[n > 0] = n.sum() / ((n > 0).sum() * n[n > 0])
                tree = part * TASK_TREES + i
                levels = grow_tree(tree, 0, own, bins[on], copies, rows, scale, sizes, chosen, g)
                yield pack_tree(tree, *(np.concatenate([v[k] for v in levels]) for k in range(1, 6)), scale, width)

    return blocks.repartitionById(parts, F.col("part")).mapInArrow(run, PACKED)


def _side_by_side(base: DataFrame, count: int, sizes: DataFrame) -> DataFrame:
    """Rows of equal label and bins next to each other in a task, but those of a cell that is too large for one."""
    parts = shuffle_partitions(base)
    most = -(-count // parts)
    hot = sizes.where(F.col("n") > most).withColumn("_of", F.ceil(F.col("n") / F.lit(most)))  # less than ``parts`` cells
    if not hot.isEmpty():
        base = base.join(F.broadcast(hot.drop("n")), ["label", "bins"], "left")
        dealt = F.coalesce(F.pmod(F.xxhash64("key"), F.col("_of")), F.lit(0))
    else:
        dealt = F.lit(0)
    return base.repartition(parts, "label", "bins", dealt).sortWithinPartitions("label", "bins").select("key", "label", "bins")


def _kept(df: DataFrame, paths: list[str], name: str, by: str | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    paths.append(path)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grow_forest(rows: DataFrame, key: str, label: str, features: str, width: int, classes: int, g: Growth) -> DataFrame:
    """The node table of a forest over ``rows`` (key, label index, features array<double>)."""
    packed, cuts = grow_trees(rows, key, label, features, width, classes, g)
    return node_table(packed, cuts, classes)


def grow_trees(rows: DataFrame, key: str, label: str, features: str, width: int, classes: int, g: Growth) -> tuple[DataFrame, list[list[float]]]:
    """The packed trees of a forest over ``rows`` (key, label index, features array<double>), and the cuts of each feature.

    Level tables are deleted as soon as they have been counted.
    """
    spark = rows.sparkSession
    cuts = feature_cuts(rows, key, features, width, g.seed)
    sizes = np.array([len(own) + 1 for own in cuts])
    base = _kept(rows.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), _binned(features, cuts).alias("bins")), paths := [], "rows")
    count = cells = base.count()
    if count > FEW_ROWS:
        equal = _kept(base.groupBy("label", "bins").agg(F.count(F.lit(1)).alias("n")), paths, "cells")
        cells = equal.count()
    merged = count > FEW_ROWS and 2 * cells <= count
    chosen = g.features or max(1, int(math.sqrt(width)))
    if (cells if merged else count) <= 2 * FINISH_ROWS:
        blocks = bag_blocks(_side_by_side(base, count, equal) if merged else base, g.trees, g.seed, width, merged)
        packed = _kept(grow_whole(blocks, sizes, chosen, width, classes, g), [], "trees")
    else:
        found: list[DataFrame] = []
        for first in range(0, g.trees, GROUP_TREES):
            bag = bags(base, "key", first, min(first + GROUP_TREES, g.trees), g.seed)
            weights = settle_bounded(bag_weights(bag, "label", g.balanced).select("tree", "label", "weight"))
            weighted = bag.join(weights, ["tree", "label"]).select(
                "tree", F.lit(0).cast("long").alias("node"), "label", "bins", (F.col("copies") * F.col("weight")).alias("w"), "copies", F.lit(_LARGE).alias("state"))
            found += _grow_group(weighted, chosen, width, classes, g, sizes)
        packed = _kept(packed_tables(reduce(DataFrame.unionByName, found), width), [], "trees")
    for path in paths:
        delete_path(spark, path)
    return packed, cuts


def _grow_group(start: DataFrame, chosen: int, width: int, classes: int, g: Growth, sizes: np.ndarray) -> list[DataFrame]:
    spark = start.sparkSession
    levels: list[str] = []
    splitting: list[str] = []
    found: list[DataFrame] = []
    by_class = F.map_from_entries(F.collect_list(F.struct("label", "w")))
    weights = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.coalesce(F.try_element_at("by_class", i), F.lit(0.0)))
    active = _kept(start, levels, "level", "state")
    for depth in range(g.depth + 1):
        states = {r["state"] for r in active.select("state").distinct().collect()}
        if _SMALL in states:
            found.append(_kept(finish(active.where(F.col("state") == _SMALL), chosen, width, classes, g, sizes), [], "nodes"))
        if states <= {_SMALL}:
            break
        # What the other nodes of this level hold, and how those that grow are split.
        held = active.where(F.col("state") != _SMALL).groupBy("tree", "node", "label").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        held = held.groupBy("tree", "node").agg(by_class.alias("by_class"), F.sum("n").alias("rows")).withColumn("weights", weights)
        growing = active.where(F.col("state") == _LARGE)
        splits = _kept(best_splits(growing, chosen, width, g), splitting, "splits")
        held = held.join(splits.select("tree", "node", "f", "b", "gain"), ["tree", "node"], "left")
        found.append(_kept(held.select("tree", "node", "f", F.col("b").cast("int").alias("b"), "gain", "weights", "rows"), [], "nodes"))
        active = _kept(_level(growing, splits, depth, g), levels, "level", "state")
        delete_path(spark, levels.pop(0))
    for path in levels + splitting:
        delete_path(spark, path)
    return found
