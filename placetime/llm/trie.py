"""The trie of conversation prefixes, from sorted sequences and their LCPs.

Method: a conversation is the sequence of its turns' digests (128 bits of role
and text).  All sequences are sorted, so the members of a node, the sequences
that begin with its prefix, are an interval.  A sparse table answers the least
LCP of any range, and each prefix binary-searches on it how far its interval
reaches to the left and to the right, on its own and without a stack.  Sizes,
leaves and sums below a node are differences of running sums over its interval.

The sorted sequences are dealt to blocks of bounded size.  A node that lies
inside one block is complete there.  A node that crosses a block's edge is a
prefix of the edge's sequence, so each block passes on at most that many partial
rows; a second sparse table over two numbers per block (the LCP at its left edge
and the least one inside) tells in which block such a node begins, the partial
rows are added up, and a second pass over the blocks hands out the results.

Defined results: rows without a conv_id belong to no conversation; turns are
ordered by turn, null first, then by digest, and repeated rows are turns of
their own; a null role or text is empty; a conversation without turns is a
member of the root alone; an empty table has no nodes; other columns are
ignored.  One conversation's digests (16 bytes a turn) must fit one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

WIDTH = 16  # bytes of a digest
BLOCK_TURNS = 1 << 18
SHARED, HEAD = 100, 6
FAR = 1 << 40
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PARTIALS = "index long, depth long, starts boolean, n long, least long, children long, leaves long, closed long, tokens long, ends string, edge long, inner long"


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


class Minima:
    """Sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value at places first to last."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k, values in enumerate(self.levels):
            on = level == k
            out[on] = np.minimum(values[first[on]], values[last[on] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to which all values behind ``at`` are ``depth`` at least."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            fits = at + (1 << k) < self.n
            fits[fits] = self.levels[k][at[fits] + 1] >= depth[fits]
            at[fits] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from which all values behind it up to ``at`` are ``depth`` at least."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            fits = at >= 1 << k
            fits[fits] = self.levels[k][at[fits] - (1 << k) + 1] >= depth[fits]
            at[fits] -= 1 << k
        return at


def common_prefix(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(k[: min(len(a), len(b))], f"V{WIDTH}") for k in (a, b))
    other = np.flatnonzero(x != y)
    return int(other[0]) if len(other) else len(x)


class Block:
    """Nodes of one block of sorted sequences, in preorder: by first member, then by depth.

    The first sequence has all its prefixes as nodes, also those that began in
    an earlier block (``open_left``); any other has those that are new with it.
    """

    def __init__(self, ids: np.ndarray, keys: list[bytes], before: bytes | None, after: bytes | None):
        m, self.ids = len(ids), ids
        length = self.length = np.array([len(k) // WIDTH for k in keys], np.int64)
        lcp = self.lcp = np.empty(m + 1, np.int64)  # with the sequence before; -1 at the ends of the whole table
        lcp[0] = -1 if before is None else common_prefix(before, keys[0])
        lcp[m] = -1 if after is None else common_prefix(keys[-1], after)
        lcp[1:m] = self._inner(keys, length)
        new = length - lcp[:m]
        new[0] = length[0] + 1
        first = self.first = np.concatenate([[0], np.cumsum(new)])  # of each sequence's nodes
        at = self.at = np.repeat(np.arange(m), new)
        depth = self.depth = np.arange(first[-1]) - first[at] + np.where(at == 0, 0, lcp[at] + 1)
        inner = np.concatenate([[FAR], lcp[1:m]])
        self.least_lcp = int(inner.min())
        minima = Minima(inner)
        last = self.last = minima.right(at, depth)
        self.open_left = (at == 0) & (depth <= lcp[0])
        self.open_right = (last == m - 1) & (depth <= lcp[m])
        self.open = self.open_left | self.open_right
        self.n = last - at + 1
        self.least = Minima(ids).least(at, last)
        leaf = np.concatenate([[0], np.cumsum(length > lcp[1:])])
        self.leaves = leaf[last + 1] - leaf[at]
        # The parent: one depth less, beginning where that prefix reaches to on the left.
        reach = np.where(depth > 0, minima.left(at, depth - 1), 0)
        self.parent = np.where(depth > 0, first[reach] + depth - 1 - np.where(reach == 0, 0, lcp[reach] + 1), -1)
        born = ~self.open_left & (depth > 0)
        self.children = np.bincount(self.parent[born], minlength=len(at))

    @staticmethod
    def _inner(keys: list[bytes], length: np.ndarray) -> np.ndarray:
        flat = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        start = np.cumsum(length) - length
        shared = np.minimum(length[:-1], length[1:])
        pair = np.repeat(np.arange(len(shared)), shared)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(shared) - shared, shared)
        other = (flat[start[pair] + step] != flat[start[pair + 1] + step]).any(1)
        out = shared.copy()
        np.minimum.at(out, pair[other], step[other])
        return out

    def tokens(self, lens: np.ndarray) -> np.ndarray:
        """Length of each node's last turn (the root has none); ``lens`` of all turns in order."""
        place = (np.cumsum(self.length) - self.length)[self.at] + self.depth - 1
        return np.where(self.depth > 0, lens[np.maximum(place, 0)] if len(lens) else 0, 0)

    def below(self, value: np.ndarray) -> np.ndarray:
        """Sum of a value over each node's part of this block's nodes, itself included."""
        total = np.concatenate([[0], np.cumsum(value)])
        return total[self.first[self.last + 1]] - total[:-1]

    def ends(self, nodes: np.ndarray) -> list[str | None]:
        """Ids of the members that end at each node, joined by commas; they stand first in its interval."""
        m = len(self.ids)
        again = (self.lcp[1:m] == self.length[1:]) & (self.length[:-1] == self.length[1:])
        stop = np.append(np.flatnonzero(~again) + 1, m)
        out: list[str | None] = []
        for i in nodes.tolist():
            a = self.at[i]
            if self.depth[i] != self.length[a]:
                out.append(None)
                continue
            out.append(",".join(map(str, self.ids[a : stop[np.searchsorted(stop, a, "right")]].tolist())))
        return out


def _block(rows: pa.Table, edges: pa.Table) -> tuple[Block, np.ndarray]:
    rows = rows.sort_by([("key", "ascending"), ("conv_id", "ascending")])
    edge = edges.filter(pc.equal(edges["depth"], -1)).to_pylist()[0]
    block = Block(rows["conv_id"].to_numpy(), rows["key"].to_pylist(), edge["before"], edge["after"])
    return block, block.tokens(rows["lens"].combine_chunks().flatten().to_numpy())


def partials(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """Partial rows of the nodes that cross this block's edges, and one row (depth -1) of the block itself."""
    schema = arrow_schema(PARTIALS)
    if not rows.num_rows:
        return schema.empty_table()
    block, tokens = _block(rows, edges)
    closed = block.below(np.where(block.open, 0, (block.n - 1) * tokens))
    on = np.flatnonzero(block.open)
    index, none = rows["index"][0].as_py(), [None]
    cols = [[index] * (len(on) + 1), [*block.depth[on].tolist(), -1], [*(~block.open_left[on]).tolist(), False]]
    cols += [[*x[on].tolist(), None] for x in (block.n, block.least, block.children, block.leaves, closed, tokens)]
    cols += [[*block.ends(on), None], none * len(on) + [int(block.lcp[0])], none * len(on) + [block.least_lcp]]
    return pa.table([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def nodes(rows: pa.Table, known: pa.Table) -> pa.Table:
    """All nodes that begin in this block; ``known`` has the whole values of those that cross its edges."""
    schema = arrow_schema(NODES)
    if not rows.num_rows:
        return schema.empty_table()
    block, tokens = _block(rows, known)
    known = known.filter(pc.greater_equal(known["depth"], 0)).sort_by([("depth", "ascending"), ("starts", "ascending")])
    on = np.flatnonzero(block.open)
    on = on[np.lexsort((~block.open_left[on], block.depth[on]))]
    saved = block.below((block.n - 1) * tokens)
    own = {"conv": block.least, "n": block.n, "children": block.children, "leaves": block.leaves, "saved": saved}
    for c, values in own.items():
        if len(on):
            values[on] = known[c].to_numpy()
    begin = np.flatnonzero(~block.open_left)
    ends = [hashlib.sha256((x or "").encode()).hexdigest() for x in block.ends(begin)]
    if len(on):
        whole = dict(zip(on.tolist(), known["sha"].to_pylist(), strict=True))
        ends = [whole.get(i) or x for i, x in zip(begin.tolist(), ends, strict=True)]
    parent = block.parent[begin]
    cols = [own["conv"][begin], block.depth[begin], pa.array(own["conv"][parent], mask=parent < 0), *(own[c][begin] for c in ("n", "children", "leaves", "saved")), ends]
    return pa.table([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: digest (hex) and length in code points of each conversation's turns in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"), digest.alias("digest"), F.char_length(text).alias("len"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["len"].alias("len"))).alias("turns"))


def rebuilt(conversations: DataFrame, shared: int = SHARED, head: int = HEAD) -> DataFrame:
    """Each conversation c behind the first h turns of conversation c - c % ``shared``, h = crc32(c) % ``head``
    (a negative id's remainder is negative, as in SQL)."""
    own = stored(conversations.sparkSession, sequences(conversations), "turns")
    heads = own.where(F.col("conv_id") % shared == 0).select(F.col("conv_id").alias("donor"), F.slice("turns", 1, head - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % shared == F.col("donor"), "left")
    first = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    return joined.select("conv_id", F.concat(first, F.slice("turns", h + 1, F.size("turns") + 1)).alias("turns"))


def in_blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """block, conv_id, key, lens, sorted by key and id over blocks of ``block_turns`` turns (or one conversation)."""
    rows = rows.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
                       F.transform("turns", lambda t: t["len"].cast("long")).alias("lens"))
    rows = stored(rows.sparkSession, rows, "sequences")
    weight = rows.agg(F.coalesce(F.sum(F.size("lens") + 1), F.lit(0)).alias("w")).first()["w"]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-weight // block_turns))
    names = ["block", "conv_id", "key", "lens"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            size = pc.list_value_length(batch["lens"]).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            block = base + (seen + np.cumsum(size) - size) // block_turns
            seen += int(size.sum())
            yield pa.RecordBatch.from_arrays([pa.array(block), batch["conv_id"], batch["key"], batch["lens"]], names=names)

    rows = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    return rows.mapInArrow(run, "block long, conv_id long, key binary, lens array<long>")


def _numbered(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their block's number, and the keys before and behind each block."""
    edges = stored(spark, rows.groupBy("block").agg(F.min("key").alias("low"), F.max("key").alias("high")), "block-edges")
    order = [(r["block"], k) for k, r in enumerate(edges.select("block").orderBy("block").collect())]  # a number per block
    number = spark.createDataFrame(order, "block long, index long")
    edges = edges.join(number, "block")
    before = edges.select((F.col("index") + 1).alias("index"), F.col("high").alias("before"))
    after = edges.select((F.col("index") - 1).alias("index"), F.col("low").alias("after"))
    around = edges.select("index").join(before, "index", "left").join(after, "index", "left").withColumn("depth", F.lit(-1).cast("long"))
    return rows.join(number, "block").select("index", "conv_id", "key", "lens"), around


def _begin(open_: DataFrame, edge: np.ndarray) -> DataFrame:
    """Add ``a``, the block in which a node begins; edge: the least LCP of each block and its left edge."""
    minima = Minima(edge)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts = batch["index"].to_numpy(), batch["starts"].to_numpy(zero_copy_only=False)
            # From the block before, over all those that the node's prefix spans, to one that it does not.
            a = np.where(starts, at, minima.left(np.maximum(at - 1, 0), batch["depth"].to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a, pa.int64())], names=[*batch.schema.names, "a"])

    return open_.mapInArrow(run, PARTIALS + ", a long")


def _hashes(open_: DataFrame) -> DataFrame:
    """a, depth, sha: of the ids of all blocks, one after the other; a running hash holds no list."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for a, depth, ends in zip(batch["a"].to_pylist(), batch["depth"].to_pylist(), batch["ends"], strict=True):
                if (a, depth) != node:
                    done += [(*node, state.hexdigest())] if node else []
                    node, state = (a, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_buffer())
        done += [(*node, state.hexdigest())] if node else []
        yield pa.RecordBatch.from_pylist([dict(zip(("a", "depth", "sha"), x, strict=True)) for x in done], arrow_schema("a long, depth long, sha string"))

    rows = open_.where(F.col("ends").isNotNull()).select("a", "depth", "index", "ends")
    return rows.repartition("a", "depth").sortWithinPartitions("a", "depth", "index").mapInArrow(run, "a long, depth long, sha string")


def _whole(spark: SparkSession, part: DataFrame) -> DataFrame:
    """index, depth, starts, conv, n, children, leaves, saved, sha of the nodes that cross edges, for every block they touch."""
    summary = part.where("depth = -1").select("index", F.least("edge", "inner").alias("e")).orderBy("index").collect()  # a number per block
    open_ = stored(spark, _begin(part.where("depth >= 0"), np.array([r["e"] for r in summary], np.int64)), "open-nodes")
    total = open_.groupBy("a", "depth").agg(F.min("least").alias("conv"), F.sum("n").alias("n"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"),
                                            F.sum("closed").alias("closed"), F.max("index").alias("e"), F.max("tokens").alias("tokens"))
    total = stored(spark, total.withColumn("own", (F.col("n") - 1) * F.col("tokens")), "crossing-nodes")
    # Below a node: what is closed there, the crossing nodes that begin in the blocks it spans,
    # and those that begin with it and are deeper.
    begun = np.zeros(len(summary) + 1, np.int64)
    for r in total.groupBy("a").agg(F.sum("own").alias("s")).collect():  # a number per block
        begun[r["a"] + 1] = r["s"]
    begun = np.cumsum(begun)
    names = [*total.columns, "between"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            between = begun[batch["e"].to_numpy()] - begun[batch["a"].to_numpy() + 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(between)], names=names)

    kinds = ", ".join(f"{c} long" for c in names)
    deeper = F.sum("own").over(Window.partitionBy("a").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))
    total = total.mapInArrow(run, kinds).withColumn("saved", F.col("closed") + F.col("between") + deeper)
    total = total.join(_hashes(open_), ["a", "depth"], "left")
    return open_.select("index", "a", "depth", "starts").join(total, ["a", "depth"]).select("index", "depth", "starts", "conv", "n", "children", "leaves", "saved", "sha")


def prefix_trie(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv_id, turns as ``sequences`` gives them)."""
    spark = rows.sparkSession
    rows, around = _numbered(spark, stored(spark, in_blocks(rows, block_turns), "sorted-sequences"))
    rows, around = stored(spark, rows, "blocks"), stored(spark, around, "edges")
    by_block = lambda df: df.groupBy("index")
    part = stored(spark, by_block(rows).cogroup(by_block(around)).applyInArrow(partials, PARTIALS), "partial-nodes")
    known = around.unionByName(_whole(spark, part), allowMissingColumns=True)
    return by_block(rows).cogroup(by_block(known)).applyInArrow(nodes, NODES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


SQL = """
WITH turn AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns FROM turn GROUP BY conv_id),
hashed AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda h, x: CASE WHEN x >= 0 THEN xor(h, x) WHEN h % 2 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT) % 6 AS h FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(d.turns, [])[1:o.h], o.turns[(o.h + 1):]) AS turns
  FROM hashed o LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 100),
prefix AS (SELECT conv_id, len(turns) AS size, d, turns[1:d] AS p FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, string_agg(CASE WHEN size = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM prefix GROUP BY p, d),
child AS (SELECT p[1:(d - 1)] AS p, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT p[1:k] AS p, k AS d, CAST(sum(leaf) AS BIGINT) AS leaves, CAST(sum(w) AS BIGINT) AS saved FROM (
    SELECT n.p, unnest(range(n.d + 1)) AS k, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf,
           CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * length(n.p[n.d].text) END AS w
    FROM node n LEFT JOIN child c ON c.d = n.d AND c.p = n.p) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
       b.saved AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM node n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN child c ON c.d = n.d AND c.p = n.p
LEFT JOIN node up ON up.d = n.d - 1 AND up.p = n.p[1:(n.d - 1)]
"""
