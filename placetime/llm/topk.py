"""Exact top-k inner products by best-first search in M-trees.

Method: vectors become integers (floor of 1024 x).  With one more coordinate
that lifts every vector to the same length, a larger inner product is a
smaller Euclidean distance, so a metric tree applies.  Candidates are dealt to
blocks of bounded size; each block is an M-tree of paged nodes holding routing
vectors, covering radii and distances to the parent.  A query visits nodes in
the order of their least possible distance, and skips entries whose distance
is already ruled out by the triangle inequality over stored distances, without
computing it.  Final scores are exact integers; bounds carry a slack above
their rounding error, so ties survive.

Queries are replicated to the blocks in chunks (blocks x query chunks, each of
bounded size), and a query's best k of every block meet in a window over at
most k rows per block.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows without an id, nor those with a component
so large that an inner product may leave 64 bits (``limit``); vectors of
different lengths are never compared; of several vectors with a query's id the
least asks, and rows that share that id are not its candidates; other repeated
rows are ranked one by one; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

K = 10
SCALE = 1024
QUERY_EVERY = 100
BLOCK_ROWS = 8192
CHUNK_QUERIES = 1024
PAGE = 128
FANOUT = 8


class MTree:
    """Bulk-loaded over rows of ``points`` (float64); ids are row numbers.

    nodes[i] = (is_leaf, entries, radii, to_parent): for a leaf ``entries`` are
    row numbers; otherwise (child numbers, routing vectors).  to_parent holds
    the distances of the entries' vectors to the node's own routing vector.
    """

    def __init__(self, points: np.ndarray):
        self.points, self.nodes = points, []
        rows = np.arange(len(points))
        self.center = points.mean(0) if len(points) else None
        self.root = self._build(rows, self.center, 0)[0] if len(points) else None

    def _build(self, rows: np.ndarray, center: np.ndarray, depth: int) -> tuple[int, float]:
        away = np.sqrt(((self.points[rows] - center) ** 2).sum(1))
        radius = float(away.max())
        if len(rows) <= PAGE or depth > 24 or radius == 0.0:
            self.nodes.append((True, rows, None, away))
            return len(self.nodes) - 1, radius
        # Routing vectors: the farthest point first, then farthest from those taken.
        routes, least = [int(np.argmax(away))], None
        while len(routes) < min(FANOUT, len(rows)):
            d = ((self.points[rows] - self.points[rows[routes[-1]]]) ** 2).sum(1)
            least = d if least is None else np.minimum(least, d)
            if least.max() == 0:
                break
            routes.append(int(np.argmax(least)))
        vectors = self.points[rows[routes]]
        near = np.argmin(((self.points[rows] ** 2).sum(1)[:, None] - 2 * self.points[rows] @ vectors.T + (vectors**2).sum(1)), 1)
        children, radii, kept = [], [], []
        for j in range(len(routes)):
            own = rows[near == j]
            if len(own):
                child, r = self._build(own, vectors[j], depth + 1)
                children.append(child)
                radii.append(r)
                kept.append(j)
        vectors = vectors[kept]
        to_parent = np.sqrt(((vectors - center) ** 2).sum(1))
        self.nodes.append((False, (np.array(children), vectors), np.array(radii), to_parent))
        return len(self.nodes) - 1, radius

    def search(self, q: np.ndarray, evaluate, slack: float) -> None:
        """Visit nodes best first.  ``evaluate(rows)`` scores rows and returns the
        distance that still matters (infinite until k are known)."""
        if self.root is None:
            return
        limit = np.inf
        start = float(np.sqrt(((q - self.center) ** 2).sum()))
        queue, n = [(0.0, 0, self.root, start)], 0
        while queue:
            bound, _, node, to_center = heapq.heappop(queue)
            if bound > limit + slack:
                return
            is_leaf, entries, radii, to_parent = self.nodes[node]
            if is_leaf:
                rows = entries[np.abs(to_center - to_parent) <= limit + slack]
                if len(rows):
                    limit = evaluate(rows)
                continue
            children, vectors = entries
            open_ = np.flatnonzero(np.abs(to_center - to_parent) - radii <= limit + slack)
            away = np.sqrt(((vectors[open_] - q) ** 2).sum(1))
            for i, d in zip(open_.tolist(), away.tolist(), strict=True):
                least = max(bound, d - radii[i], 0.0)
                if least <= limit + slack:
                    n += 1
                    heapq.heappush(queue, (least, n, int(children[i]), d))


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query_id, vec_id, score) of each query's best k in one block (int64 vectors)."""
    real = vectors.astype(np.float64)
    norm = (real**2).sum(1)
    top = float(norm.max())
    tree = MTree(np.concatenate([real, np.sqrt(np.maximum(top - norm, 0))[:, None]], 1))
    out = []
    for query_id, query in zip(query_ids.tolist(), queries, strict=True):
        q = query.astype(np.float64)
        length = float((q**2).sum())
        best_score, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        state = [best_score, best_id]

        def evaluate(rows, query=query, query_id=query_id, length=length, state=state):
            rows = rows[ids[rows] != query_id]
            score = np.concatenate([state[0], vectors[rows] @ query])
            vec = np.concatenate([state[1], ids[rows]])
            order = np.lexsort((vec, -score))[:k]
            state[0], state[1] = score[order], vec[order]
            return np.sqrt(max(length + top - 2.0 * float(state[0][-1]), 0.0)) if len(order) == k else np.inf

        tree.search(np.append(q, 0.0), evaluate, 1e-6 * (1.0 + np.sqrt(length + top)))
        out += [(query_id, v, s) for v, s in zip(state[1].tolist(), state[0].tolist(), strict=True)]
    return out


def limit(dim: int) -> int:
    """Components of up to this size keep inner products over ``dim`` components within 64 bits."""
    return math.isqrt(2**62 // max(1, dim))


def as_integers(vectors: DataFrame) -> DataFrame:
    """id, v (array<long>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where(F.col("id").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: F.coalesce(finite(x), F.lit(False))))
    most = F.sqrt(F.lit(2.0**62) / F.size("e")) - 1
    rows = rows.where(F.forall("e", lambda x: F.abs(x * SCALE) < most))
    return rows.select("id", F.transform("e", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))


def search(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for queries whose id is divisible by ``query_every``."""
    rows = stored(vectors.sparkSession, as_integers(vectors).withColumn("dim", F.size("v")), "vectors")
    asked = rows.where(F.col("id") % query_every == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    blocks, chunks = max(1, -(-rows.count() // block_rows)), max(1, -(-asked.count() // CHUNK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiles = rows.select("id", "v", "dim", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"), every(chunks).alias("chunk"))
    asked = asked.select(F.col("id").alias("q_id"), F.col("v").alias("q_v"), F.col("dim").alias("q_dim"),
                         every(blocks).alias("q_block"), F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("q_chunk"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(own: pa.Table, queries: pa.Table) -> pa.Table:
        if not own.num_rows or not queries.num_rows:
            return out.empty_table()
        matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        found = search_block(own["id"].to_numpy(), matrix(own, "v"), queries["q_id"].to_numpy(), matrix(queries, "q_v"), k)
        return pa.table([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=out) if found else out.empty_table()

    best = tiles.groupBy("dim", "block", "chunk").cogroup(asked.groupBy("q_dim", "q_block", "q_chunk")).applyInArrow(
        run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
