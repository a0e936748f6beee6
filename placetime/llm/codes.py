"""Product codes of vectors by dual-tree Lloyd iterations.

Method: vectors become integers (floor of 1024 x) and are cut into equal parts;
every part position has a codebook.  Blocks of vectors are packed once, without
a shuffle, each with a box tree over its parts per position, whose nodes keep
their parts' sum.  In a round the codebook gets a box tree as well, and the two
trees are walked together: bounds on the distance between a node of parts and a
node of entries, exact in integers, rule out nodes of entries for all parts of
the node at once.  When one entry is left, the whole node is assigned by its
cached sum; a leaf with several left compares integers.  Sums per entry are
added up by Spark; only the codebooks reach the driver, ``entries`` rows per part.

Defined results: rows whose vector is null or holds a null or non-finite
component are dropped.  The number of components is that of the vector with the
smallest vec_id whose length the parts divide; rows of another length, and rows
with a component too large for 64-bit distances (see ``limit``), stay with null
code and errors and take no part.  Equal vec_ids are ordered by vector, a null
vec_id comes last; repeated rows count each; fewer rows than entries give fewer
entries; null labels are one group; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK_ROWS = 8192
LEAF = 32
#: Label sums up to this many rows are broadcast (a label and a long each).
BROADCAST_LABELS = 200_000
SALT = 16


def limit(dim: int) -> int:
    """Components up to this size keep squared distances over ``dim`` components within 64 bits."""
    return math.isqrt(2**60 // max(1, dim))


class BoxTree:
    """Halves rows at the median of the widest component.

    Node i covers rows start[i] to end[i] of ``order``, lies between lo[i] and
    hi[i], sums to total[i] and has children left[i] and left[i] + 1 (0: a leaf).
    """

    FIELDS = ("order", "start", "end", "left", "lo", "hi", "total")

    def __init__(self, points: np.ndarray, leaf: int):
        order = np.arange(len(points))
        nodes = [[0, len(points), 0]]
        k = 0
        while k < len(nodes):
            a, b, _ = nodes[k]
            own = points[order[a:b]]
            spread = own.max(0) - own.min(0)
            if b - a > leaf and spread.max() > 0:
                wide, middle = int(spread.argmax()), (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, wide], middle)]
                nodes[k][2] = len(nodes)
                nodes += [[a, a + middle, 0], [a + middle, b, 0]]
            k += 1
        self.order, (self.start, self.end, self.left) = order, np.array(nodes, np.int64).T
        rows = points[order]
        self.lo, self.hi, self.total = (np.array([f(rows[a:b], 0) for a, b, _ in nodes]) for f in (np.min, np.max, np.sum))

    @classmethod
    def load(cls, fields: dict, prefix: str) -> BoxTree:
        tree = cls.__new__(cls)
        for f in cls.FIELDS:
            setattr(tree, f, fields[prefix + f])
        return tree


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows; doubles only hold them where they are exact."""
    most = max(int(np.abs(points).max()), int(np.abs(entries).max()))
    kind = np.float64 if points.shape[1] * 4 * most * most < 2**53 else np.int64
    a, b = points.astype(kind), entries.astype(kind)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)


def assign(points: np.ndarray, tree: BoxTree, entries: np.ndarray, codes: np.ndarray | None = None):
    """Count and sum of the points nearest to every entry (ties: the lower one); fills ``codes`` by row."""
    own = BoxTree(entries, 1)
    lowest = np.minimum.reduceat(own.order[np.concatenate([np.arange(a, b) for a, b in zip(own.start, own.end, strict=True)])],
                                 np.cumsum(own.end - own.start) - (own.end - own.start))
    single = own.left == 0  # one entry, or equal ones of which the lowest counts
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    walk = [(0, np.zeros(1, np.int64))]
    while walk:
        node, near = walk.pop()
        lo, hi = tree.lo[node], tree.hi[node]
        while True:
            gap = np.maximum(0, np.maximum(own.lo[near] - hi, lo - own.hi[near]))
            reach = np.maximum(own.hi[near] - lo, hi - own.lo[near])
            near = near[(gap * gap).sum(1) <= (reach * reach).sum(1).min()]
            if len(near) > 1 or single[near[0]]:
                break
            near = np.array([own.left[near[0]], own.left[near[0]] + 1])
        rows = slice(tree.start[node], tree.end[node])
        if len(near) == 1:  # the whole node goes to one entry
            e = lowest[near[0]]
            count[e] += rows.stop - rows.start
            total[e] += tree.total[node]
            if codes is not None:
                codes[tree.order[rows]] = e
            continue
        if tree.left[node]:
            # The children meet the children of the entries' nodes.
            inner = own.left[near]
            near = np.concatenate([near[inner == 0], inner[inner > 0], inner[inner > 0] + 1])
            walk += [(tree.left[node], near), (tree.left[node] + 1, near)]
            continue
        left = np.unique(np.concatenate([own.order[own.start[c] : own.end[c]] for c in near]))
        held = points[tree.order[rows]]
        found = left[distances(held, entries[left]).argmin(1)]
        np.add.at(count, found, 1)
        np.add.at(total, found, held)
        if codes is not None:
            codes[tree.order[rows]] = found
    return count, total


def as_integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v (array<long>; null with a component beyond ``limit``) of the rows that are kept."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("e"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where(F.col("e").isNotNull() & F.forall("e", lambda x: F.coalesce(finite(x), F.lit(False))))
    most = F.sqrt(F.lit(2.0**60) / F.greatest(F.size("e"), F.lit(1))) - 1
    fits = F.forall("e", lambda x: F.abs(x * SCALE) < most)
    return rows.select("vec_id", "label", F.when(fits, F.transform("e", lambda x: F.floor(x * SCALE).cast("long"))).alias("v"))


def pack(rows: DataFrame, parts: int, dim: int, block_rows: int) -> DataFrame:
    """One row per block of vectors: vec_id and label arrays, vectors and their trees."""
    types = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    names = ["vec_id", "label", "packed"]

    def block(held: pa.Table) -> pa.RecordBatch:
        vectors = held["v"].combine_chunks().flatten().to_numpy().reshape(held.num_rows, dim)
        fields = {"vectors": vectors}
        for p, own in enumerate(np.split(vectors, parts, 1)):
            tree = BoxTree(own, LEAF)
            fields |= {f"{p}{f}": getattr(tree, f) for f in BoxTree.FIELDS}
        out = io.BytesIO()
        np.savez(out, **fields)
        lists = [pa.ListArray.from_arrays(pa.array([0, held.num_rows], pa.int32()), held[c].combine_chunks()) for c in names[:2]]
        return pa.RecordBatch.from_arrays([*lists, pa.array([out.getvalue()], pa.binary())], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows >= block_rows:
                yield block(held.slice(0, block_rows).combine_chunks())
                held = held.slice(block_rows)
        if held is not None and held.num_rows:
            yield block(held.combine_chunks())

    fit = rows.where(F.size("v") == dim)
    return fit.mapInArrow(run, f"vec_id array<{types['vec_id']}>, label array<{types['label']}>, packed binary")


def _trees(packed: bytes, parts: int) -> Iterator[tuple[np.ndarray, BoxTree]]:
    fields = np.load(io.BytesIO(packed))
    for p, own in enumerate(np.split(fields["vectors"], parts, 1)):
        yield own, BoxTree.load(fields, str(p))


def update(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round: every entry becomes the floor of its parts' mean, unused ones stay."""
    width = books[0].shape[1]
    names = ["part", "entry", "n", *(f"s{i}" for i in range(width))]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
        for batch in batches:
            for packed in batch["packed"]:
                for p, (own, tree) in enumerate(_trees(packed.as_py(), len(books))):
                    for total, more in zip(sums[p], assign(own, tree, books[p]), strict=True):
                        total += more
        for p, (n, s) in enumerate(sums):
            used = np.flatnonzero(n)
            cols = [np.full(len(used), p), used, n[used], *s[used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    sums = blocks.select("packed").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    found = sums.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names[2:])).collect()  # parts x entries rows at most
    books = [b.copy() for b in books]
    for r in found:
        books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every packed vector."""
    types = {c: blocks.schema[c].dataType.elementType.simpleString() for c in ("vec_id", "label")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, packed in enumerate(batch["packed"]):
                codes, error = [], 0
                for p, (own, tree) in enumerate(_trees(packed.as_py(), len(books))):
                    code = np.zeros(len(own), np.int64)
                    assign(own, tree, books[p], code)
                    error = error + ((own - books[p][code]) ** 2).sum(1)
                    codes.append(code)
                text = ["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for c in codes), strict=True)]
                ids, labels = (batch[c].slice(k, 1).flatten() for c in ("vec_id", "label"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of the errors of equal labels; a hot label is salted if the sums are too many to broadcast."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = stored(coded.sparkSession, sums.withColumnRenamed("label", "of"), "label-errors")
    same = F.col("label").eqNullSafe(F.col("of"))
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same, "left").drop("of")
    salt: Column = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT))
    copies = sums.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    return coded.withColumn("salt", salt).join(copies, same & (F.col("salt") == F.col("copy")), "left").drop("of", "salt", "copy")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code, error, label_error of every kept row, and the codebooks (one array per part)."""
    spark = vectors.sparkSession
    rows = stored(spark, as_integers(vectors), "vectors")
    able = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    first = able.orderBy(*order).select("v").first()
    dim = len(first["v"]) if first else 0
    seeds = able.where(F.size("v") == dim).orderBy(*order).select("v").limit(entries).collect()
    books = np.split(np.array([r["v"] for r in seeds], np.int64), parts, 1) if seeds else []
    other = rows.where(F.col("v").isNull() | (F.size("v") != dim) | F.lit(not seeds))
    coded = other.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if seeds:
        blocks = stored(spark, pack(rows, parts, dim, block_rows), "vector-blocks")
        for _ in range(rounds):
            books = update(blocks, books)
        coded = stored(spark, encode(blocks, books), "vector-codes").unionByName(coded)
    return with_label_error(coded), books


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds in DuckDB; squared distances of integers are exact in doubles."""
    steps = ["""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT k.vec_id, k.label, p.p, k.e[(p.p * len(k.e) // 4 + 1):((p.p + 1) * len(k.e) // 4)] AS v FROM kept k, (SELECT unnest([0, 1, 2, 3]) AS p) p),
b0 AS MATERIALIZED (
  SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INTEGER) AS i, v AS c FROM part
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, label, p, v, arg_min(i, {{'d': d, 'i': i}}) AS i, min(d) AS d FROM (
    SELECT x.*, b.i, list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.c) + list_inner_product(b.c, b.c) AS d
    FROM part x JOIN b{r} b ON x.p = b.p) GROUP BY vec_id, label, p, v)""")
        if r < ROUNDS:
            steps.append(f"""
s{r} AS (SELECT p, i, list(floor(s / n) ORDER BY k) AS c FROM (
  SELECT p, i, k, sum(x) AS s, count(*) AS n FROM (SELECT p, i, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{r}) GROUP BY p, i, k) GROUP BY p, i),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.i, coalesce(s.c, b.c) AS c FROM b{r} b LEFT JOIN s{r} s ON b.p = s.p AND b.i = s.i)""")
    steps.append(f"""
coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, i, k)) AS h
          FROM (SELECT p, i, unnest(c) AS x, generate_subscripts(c, 1) AS k FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, books""")
    return steps[0] + "," + ",".join(steps[1:-1]) + "," + steps[-1]


SQL = _sql()
