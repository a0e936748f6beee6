"""Similarity join of documents on distinct 5-word shingles (Jaccard >= 0.8).

Method: a sparse product of the document by n-gram incidence, blocked by
n-gram, that accumulates overlaps and discards pairs below bounds derived from
the set sizes.

1. Every text becomes its set of 64-bit shingle hashes.  Documents with equal
   sets form one class (a 128-bit digest of the set), so exact copies cost one
   row each and never meet in pairs.
2. If two sets of sizes a <= b link, they share one of the first
   n - ceil(0.8 n) + 1 elements of each in any common order.  Only these
   entries of the incidence are shuffled.  The order puts frequent shingles
   last (frequent by a bounded list, which affects cost, never results).
   The classes of a row that have too few shared entries to reach the overlap
   their sizes ask for are left out of its pairs.
3. Within an n-gram's row of classes, ordered by how many of their entries are
   shared, each class is first paired with the first one and with its
   neighbour of next size: as many pairs as rows.  Shared entries are counted
   per pair; pairs fall by size, and by a bound from hashed bitmaps: each
   cell set in one and not in the other is an element not shared.
4. Remaining pairs are verified on the full sets, in waves of a few pairs per
   class at most; classes in one component need no further pair.
5. The product is then completed: all pairs of a row whose classes are in
   different components, minus the verified ones, go through the same bounds
   and waves.  So no link between different texts is lost, and a group of
   copies never expands into all its pairs.  Before such a pair is made, the
   parity sketches of both sets are compared: each element in one set alone
   flips one bit, so sets that differ in too many bits cannot link.  Texts that
   share a passage and little else end there.  Rows that hold the same classes,
   as all n-grams of a passage do, are one row with their number as its weight.

Defined results: a null or blank text has the empty set (0 shingles) and links
with nothing; fewer than five words are one shingle; rows that repeat an id
with the same text give one row each; a class whose ids are all null has
component null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, stored, table, text_slices
from .graph import components

WORDS = 5
PERCENT = 80
HOT_LIST = 50_000
HOT_LOCAL = 3
SLICE = 6 << 20
SETS = "doc_id long, text_key string, n long, class binary, prefix array<long>, bitmap binary, sketch array<long>"
#: Bits of the parity sketch, in longs.
SKETCH_LONGS = 8


# --- sets --------------------------------------------------------------------

def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    folded = pc.ascii_lower(text.cast(pa.large_string()).fill_null(""))
    split = pc.ascii_split_whitespace(folded)
    coded = pc.list_flatten(split).dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    real = np.fromiter((len(w) > 0 for w in names), bool, len(names))
    at = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(text)), pc.list_value_length(split).to_numpy())
    if len(at) and not real.all():
        keep = real[at]
        at, owner = at[keep], owner[keep]
    h = hashes[at] if len(at) else np.zeros(0, np.uint64)
    per = np.bincount(owner, minlength=len(text))
    edge = np.concatenate([[0], np.cumsum(per)])
    mult = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            rolled = (rolled ^ h[k : k + len(rolled)]) * mult
            rolled ^= rolled >> np.uint64(29)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def bitmap_of(own: np.ndarray) -> bytes:
    """One bit per cell of a power of two of at least 2n cells (64 or more)."""
    cells = max(64, 1 << int(2 * len(own) - 1).bit_length())
    bits = np.zeros(cells, bool)
    bits[(own & np.uint64(cells - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def sketch_of(own: np.ndarray) -> np.ndarray:
    """Parity of the number of elements per cell, 64 cells to a long.

    Two sets' sketches differ in at most as many bits as elements are in one set alone.
    """
    cells = 64 * SKETCH_LONGS
    odd = np.bincount((own >> np.uint64(32)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def overlap_bound(a: bytes, na: int, b: bytes, nb: int) -> int:
    """An upper bound of the overlap of two sets from their bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def links(overlap, na, nb):
    """100 * intersection >= 80 * union, in integers."""
    return (100 + PERCENT) * overlap >= PERCENT * (na + nb)


# --- hot shingles ------------------------------------------------------------

def hot_shingles(docs: DataFrame, most: int = HOT_LIST) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` frequent shingles and their counts, as a common order needs them.

    A task reports shingles that occur in three documents of a slice; at most
    ``most`` sums reach the driver.  Missing one costs time, never a link.
    """
    def run(batches):
        for batch in batches:
            for some in text_slices(batch, SLICE):
                key, n = np.unique(np.concatenate(shingle_sets(some["text"])), return_counts=True)
                often = n >= HOT_LOCAL
                yield pa.RecordBatch.from_arrays([pa.array(key[often].astype(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "c"])

    found = docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    rows = found.orderBy(F.desc("c"), "h").limit(most).collect()
    h = np.array([r["h"] for r in rows], np.int64).astype(np.uint64)
    c = np.array([r["c"] for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], c[order]


def sets(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text_key, n, class, prefix, bitmap and sketch of every document."""
    hot_h, hot_c = hot
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n", pa.int64()), ("class", pa.binary()), ("prefix", pa.list_(pa.int64())),
                        ("bitmap", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    def prefix(own: np.ndarray) -> np.ndarray:
        n = len(own)
        k = n - -(-PERCENT * n // 100) + 1
        if len(hot_h):
            at = np.minimum(np.searchsorted(hot_h, own), len(hot_h) - 1)
            count = np.where(hot_h[at] == own, hot_c[at], 0)
            own = own[np.argsort(count, kind="stable")]
        return own[:k].astype(np.int64)

    def run(batches):
        for batch in batches:
            for some in text_slices(batch, SLICE):
                own = shingle_sets(some["text"])
                yield pa.RecordBatch.from_arrays([
                    some["doc_id"], some["text_key"], pa.array([len(x) for x in own], pa.int64()), pa.array([class_of(x) for x in own], pa.binary()),
                    pa.array([prefix(x) if len(x) else x.astype(np.int64) for x in own], pa.list_(pa.int64())),
                    pa.array([bitmap_of(x) for x in own], pa.binary()), pa.array([sketch_of(x) for x in own], pa.list_(pa.int64()))], schema=schema)

    return docs.select("doc_id", "text", _text_key().alias("text_key")).mapInArrow(run, SETS)


def _text_key():
    return F.md5(F.coalesce("text", F.lit("")))


# --- pairs -------------------------------------------------------------------

def _sizes_fit(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _may_link(shared, a: str, b: str):
    """Whether sets of sizes ``a`` and ``b`` can link that share ``shared`` prefix entries.

    Of the two prefixes one ends first in the common order; none of its
    elements stand behind the other's prefix.  So the overlap is at most the
    shared entries and the rest of that set behind its prefix.
    """
    rest = F.ceil(F.greatest(a, b) * PERCENT / 100) - 1
    return (shared + rest) * (100 + PERCENT) >= (F.col(a) + F.col(b)) * PERCENT


def _bounded(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Pairs (a, b, shared) that the bitmaps don't rule out, with that bound."""
    side = lambda x: maps.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"map_{x}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            na, nb = batch["n_a"].to_pylist(), batch["n_b"].to_pylist()
            bound = [overlap_bound(x, i, y, j) for x, i, y, j in zip(batch["map_a"].to_pylist(), na, batch["map_b"].to_pylist(), nb, strict=True)]
            keep = pa.array([links(o, i, j) for o, i, j in zip(bound, na, nb, strict=True)], pa.bool_())
            out = pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(bound, pa.int64())], names=["a", "b", "bound"])
            yield out.filter(keep)

    return full.select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(run, "a binary, b binary, bound long")


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The components (root_a, root_b) of pairs, with ``linked`` from the pairs' full sets."""
    side = lambda x: full.select(F.col("class").alias(x), F.col("members").alias(f"set_{x}"))

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                ok.append(bool(links(int((y[at] == x).sum()), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([batch["root_a"], batch["root_b"], pa.array(ok, pa.bool_())], names=["root_a", "root_b", "linked"])

    both = pairs.select("a", "b", "root_a", "root_b").join(side("a"), "a").join(side("b"), "b")
    return both.select("root_a", "root_b", "set_a", "set_b").mapInArrow(run, "root_a binary, root_b binary, linked boolean")


def _full_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """class and its full set, for the classes that stand in ``pairs``."""
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    needed = needed.join(classes.select("class", "label"), "class").select(F.col("class").alias("wanted"), F.col("label").alias("wanted_id"))

    def run(batches):
        for batch in batches:
            for some in text_slices(batch, SLICE):
                own = shingle_sets(some["text"])
                names = [class_of(x) for x in own]
                keep = pa.array([x == y for x, y in zip(names, some["wanted"].to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], names=["class", "members"]).filter(keep)

    rows = docs.select("doc_id", "text").join(needed, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("text", "wanted")
    return rows.mapInArrow(run, "class binary, members binary").dropDuplicates(["class"])


def _waves(pairs: DataFrame, full: DataFrame, roots: DataFrame) -> DataFrame:
    """Verify ``pairs`` until each is verified or within one component of
    ``roots`` (node, root); returns the components after that.

    A wave tests the most promising pairs of each class: 64, then 2048, ...
    Links join components, so the graph to be closed is that of their roots.
    """
    left, most = pairs, 64
    best = Window.partitionBy("b").orderBy(F.desc("bound"), "a")
    while True:
        of = lambda x: roots.select(F.col("node").alias(f"node_{x}"), F.col("root").alias(f"root_{x}"))
        left = left.join(of("a"), F.col("a") == F.col("node_a")).join(of("b"), F.col("b") == F.col("node_b"))
        left = left.where("root_a <> root_b").select("a", "b", "bound", "root_a", "root_b")
        left = cut(left.withColumn("turn", F.row_number().over(best)))
        if left.isEmpty():
            return roots
        now = _verified(left.where(F.col("turn") <= most), full).where("linked")
        joined = components(now.select(F.col("root_a").alias("u"), F.col("root_b").alias("v")))
        joined = joined.select(F.col("node").alias("old"), F.col("root").alias("new"))
        roots = cut(roots.join(joined, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")))
        left, most = left.where(F.col("turn") > most).select("a", "b", "bound"), most * 32


def link_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, n, class) of all documents, and (node, root) of classes that share entries."""
    spark = docs.sparkSession
    rows = stored(spark, sets(docs, hot_shingles(docs)), "sets")
    classes = rows.where("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("label"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap"), F.first("sketch").alias("sketch"))
    classes = stored(spark, classes, "classes")
    entries = classes.select(F.explode("prefix").alias("gram"), "class", "n")
    row = Window.partitionBy("gram")
    entries = stored(spark, entries.withColumn("many", F.count(F.lit(1)).over(row)).where("many > 1").drop("many"), "entries")
    shared = entries.groupBy("class").agg(F.count(F.lit(1)).alias("degree"))
    entries = stored(spark, entries.join(shared, "class"), "rows")
    pairs = _first_pairs(entries)
    maps = classes.select("class", "n", "bitmap")
    pairs = cut(_bounded(pairs, maps))
    full = stored(spark, _full_sets(docs, classes, pairs), "members")
    roots = cut(entries.select(F.col("class").alias("node"), F.col("class").alias("root")).distinct())
    roots = _waves(pairs, full, roots)
    rest = cut(_bounded(_remaining(entries, classes, roots, pairs), maps))
    if not rest.isEmpty():
        roots = _waves(rest, stored(spark, _full_sets(docs, classes, rest), "members"), roots)
    return rows.select("doc_id", "text_key", "n", "class"), roots


def _first_pairs(entries: DataFrame) -> DataFrame:
    """Linear in the entries: each with the head of its row and with the next size.

    The head is the class with the most shared entries: the original of a
    group of copies has no entries of its own, its copies do.
    """
    head = Window.partitionBy("gram").orderBy(F.desc("degree"), "class")
    size = Window.partitionBy("gram").orderBy("n", "class")
    ends = F.struct("class", "n", "degree")
    near = entries.select("class", "n", "degree", F.first(ends).over(head).alias("head"), F.lag(ends).over(size).alias("next"))
    both = near.select("class", "n", "degree", F.explode(F.array("head", "next")).alias("to")).where("to is not null and to.class <> class")
    both = both.select("class", "n", "degree", "to", F.col("to.n").alias("to_n"))
    both = both.where(_sizes_fit("n", "to_n") & _may_link(F.least("degree", "to.degree"), "n", "to_n"))
    return both.select(F.least("class", "to.class").alias("a"), F.greatest("class", "to.class").alias("b")).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared"))


def _sketches_fit(x: str, y: str, a: str, b: str):
    """Whether sets of sizes ``a`` and ``b`` can link whose sketches are the columns ``x``0, ... and ``y``0, ...

    Linked sets have at most (a + b) (100 - 80) / (100 + 80) elements in one of them alone.
    """
    apart = sum((F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))) for i in range(1, SKETCH_LONGS)), F.bit_count(F.col(f"{x}0").bitwiseXOR(F.col(f"{y}0"))))
    return apart * (100 + PERCENT) <= (F.col(a) + F.col(b)) * (100 - PERCENT)


def _remaining(entries: DataFrame, classes: DataFrame, roots: DataFrame, done: DataFrame) -> DataFrame:
    """The rest of the product: pairs of a row in different components that were not tested."""
    rows = entries.join(roots, F.col("class") == F.col("node")).select("gram", "class", "n", "degree", "root")
    # Rows with the same classes make the same pairs: one of them stands for all, with their number.
    classes_of = [F.bit_xor(F.xxhash64(F.lit(seed), "class")).alias(f"x{seed}") for seed in (1, 2)]
    made = rows.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("many"), *classes_of).where("lo <> hi")
    mixed = made.groupBy("x1", "x2", "many").agg(F.min("gram").alias("g"), F.count(F.lit(1)).alias("weight")).select("g", "weight")
    rows = rows.join(mixed, F.col("gram") == F.col("g")).join(classes.select(F.col("class").alias("of"), "sketch"), F.col("class") == F.col("of"))
    rows = cut(rows.drop("g", "of"))

    def side(x: str, gram: str) -> DataFrame:
        parts = [F.get("sketch", F.lit(i)).alias(f"s{x}{i}") for i in range(SKETCH_LONGS)]
        return rows.select(F.col("gram").alias(gram), F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("degree").alias(f"d_{x}"), F.col("root").alias(f"root_{x}"), "weight", *parts)

    # A pair shares at most the shared entries of either class; once counted, what it does share.
    pairs = side("a", "gram").join(side("b", "g").drop("weight"), (F.col("gram") == F.col("g")) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
                                   & _sizes_fit("n_a", "n_b") & _may_link(F.least("d_a", "d_b"), "n_a", "n_b") & _sketches_fit("sa", "sb", "n_a", "n_b"))
    pairs = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.sum("weight").alias("shared"))
    pairs = pairs.where(_may_link(F.col("shared"), "n_a", "n_b")).select("a", "b", "shared")
    return pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")


def _rooted(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n and root (its component's class) of every row."""
    rows, roots = link_classes(docs)
    ids = rows.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    return stored(docs.sparkSession, ids.select("doc_id", "text_key", "n", "root"), "ids")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links)."""
    ids = _rooted(docs)
    # Components are named by an aggregation; the names return by a join that Spark can split.
    named = ids.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")).select(F.col("root").alias("of"), "least")
    out = ids.join(named, (F.col("root") == F.col("of")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of linked texts, with all columns.

    It is the row of smallest doc_id (a null id comes last; then by a hash of the
    text, then of the row).  Rows are decided one by one: a row whose id has
    another, linked text stays if its own text is in no other component.  Rows
    without words stay, repeated ones too.
    """
    ids = _rooted(docs).where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    first = ids.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    first = stored(docs.sparkSession, first, "first-rows")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", _text_key().alias("text_key"), (~F.coalesce("text", F.lit("")).rlike(WORD)).alias("wordless"))
    matched = rows.join(first, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key")), "left")
    kept = matched.where(F.col("wordless") | F.col("first_key").isNotNull())
    again = ids.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(
        first, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key")), "left_semi")
    if not again.isEmpty():  # of rows that agree in id and text one stays
        single = kept.where(~F.col("wordless")).groupBy("doc_id", "text_key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        kept = single.select("row").unionByName(kept.where("wordless").select("row"))
    return kept.select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
