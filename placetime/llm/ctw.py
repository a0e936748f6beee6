"""Language-model scores by context-tree weighting over bytes.

Method: a text is a string of bytes closed by an end symbol; every byte is
eight binary decisions, each with its own tree of contexts (the preceding 0 to
``DEPTH`` bytes).  A node holds a Krichevsky-Trofimov estimate, and a node's
weighted probability is the even mix of its estimate and the product of its
children.  The block probability of an estimate depends on counts alone, so
the tree is learned from one count of byte (DEPTH+1)-grams over the training
texts, bottom up; the predictive mix of all depths then gives each gram one
log probability, and a text's score is the sum over its grams.

Nothing grows in one place.  Texts are written once as bundles of bounded
size; a bundle emits its distinct grams and words with training counts; grams
travel as compressed columns (differences of sorted codes, about a byte a
gram), one row per bundle and bucket; subtrees below the last two bytes are
weighted per bucket (both of these bytes choose it, and the number of buckets
follows the count of grams; the two bytes with most grams stay together), the
255 x 256 nodes above them on the driver; and each bundle gets back only
the entries of its own grams and words.  No model is broadcast.

Defined results: a null text counts as empty (its one token is the end); a
null doc_id is a training document; without training documents every byte
costs eight bits; repeated rows are scored row by row; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_slices

DEPTH = 5
TOP = 2
BUNDLE_BYTES = 12 << 20
SLICE_BYTES = 3 << 20
BUCKETS = 128  # at least
BUCKET_GRAMS = 500_000  # of all bundles, on average
END = 0xFF  # never occurs in UTF-8
HELD_OUT = (7, 2)
LN_HALF = float(np.log(0.5))


def held_out(doc_id, modulus: int = HELD_OUT[0], rest: int = HELD_OUT[1]):
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == rest, F.lit(False))


# --- bundles -----------------------------------------------------------------

def bundles(docs: DataFrame, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Texts folded to lower case, in compressed bundles of about ``bundle_bytes``."""

    def run(batches):
        part, k, held, rows = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            text = pc.ascii_lower(batch["text"].cast(pa.large_string()).fill_null(""))
            folded = pa.RecordBatch.from_arrays([batch["doc_id"], text, batch["held_out"]], names=["doc_id", "text", "held_out"])
            for piece in text_slices(folded, SLICE_BYTES):
                rows.append(piece)
                held += pc.sum(pc.binary_length(piece["text"])).as_py() + 64 * piece.num_rows
                if held >= bundle_bytes:
                    yield _bundle(f"{part}-{k}", rows)
                    k, held, rows = k + 1, 0, []
        if rows:
            yield _bundle(f"{part}-{k}", rows)

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, "bundle string, blob binary")


def _bundle(name: str, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for row in rows:
            out.write_batch(row)
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["bundle", "blob"])


def _open(blob: bytes):
    return pa.ipc.open_stream(pa.py_buffer(blob))


# --- grams and words of a slice ----------------------------------------------

def codes_of(text: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all coded symbols, and the first and end position of each text.

    A code holds the latest context byte on top, then the older ones, then
    the symbol, so contexts of every depth are prefixes.  END symbols stand
    before each text as its context; the first one after it closes it.
    """
    pad = bytes([END]) * depth
    raw = [t.as_py() for t in text.cast(pa.large_binary())]
    a = np.frombuffer(pad + b"".join(x + pad for x in raw), np.uint8).astype(np.uint64)
    n = len(a) - depth
    code = a[depth:].copy()
    for k in range(1, depth + 1):
        code |= a[depth - k : depth - k + n] << np.uint64(8 * (depth + 1 - k))
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    first = np.cumsum(size + depth) - size - depth
    return code, first, first + size + 1


def words_of(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the index of each occurrence, and the number of words of each text.

    Blank-only pieces keep an index (of the empty word); callers leave it out.
    """
    split = pc.ascii_split_whitespace(text)
    coded = pc.list_flatten(split).dictionary_encode()
    return coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy(), pc.list_value_length(split).to_numpy()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(count, at) if len(at) else count


def count(blobs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per bundle its distinct grams (one packed row) and words with their counts in training texts (0 counts too).

    The end token is the word b"\\xff".
    """
    schema = pa.schema([("bundle", pa.string()), ("codes", pa.binary()), ("counts", pa.binary()), ("grams", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for name, blob in zip(batch["bundle"].to_pylist(), batch["blob"], strict=True):
                keys, counts, tables = [], [], []
                for piece in _open(blob.as_py()):
                    train = ~piece["held_out"].to_numpy(zero_copy_only=False)
                    code, first, end = codes_of(piece["text"], depth)
                    mark = np.zeros(len(code) + 1, np.int8)
                    np.add.at(mark, first, 1), np.add.at(mark, end, -1)
                    coded = np.cumsum(mark[:-1]) > 0
                    learn = np.repeat(train, np.diff(np.append(first, len(code))))
                    both, n = np.unique((code[coded] << np.uint64(1)) | learn[coded].astype(np.uint64), return_counts=True)
                    keys.append(both >> np.uint64(1))
                    counts.append(np.where(both & np.uint64(1), n, 0))
                    del code, mark, coded, learn, both
                    merged = _merged(keys, counts)
                    keys, counts = [merged[0]], [merged[1]]
                    word, at, per = words_of(piece["text"])
                    n = np.bincount(at, weights=np.repeat(train, per), minlength=len(word)).astype(np.int64)
                    tables.append(pa.table({"word": word, "n": pa.array(n)}))
                    tables.append(pa.table({"word": pa.array([b"\xff"], pa.large_binary()), "n": pa.array([int(train.sum())], pa.int64())}))
                if not keys:
                    continue
                key, n = keys[0], counts[0]
                yield pa.RecordBatch.from_pylist([{"bundle": name, "codes": _pack_codes(key), "counts": _pack(n), "grams": len(key)}], schema=schema)
                word = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
                word = word.filter(pc.not_equal(pc.binary_length(word["word"]), 0)).combine_chunks()
                for part in word.to_batches(max_chunksize=200_000):
                    none = pa.nulls(part.num_rows, pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([name] * part.num_rows, pa.string()), none, none, none.cast(pa.int64()),
                                                      part["word"].cast(pa.binary()), part["n_sum"]], schema=schema)
                del keys, counts, key, n, tables, word
                pa.default_memory_pool().release_unused()

    return blobs.mapInArrow(run, "bundle string, codes binary, counts binary, grams long, word binary, n long")


# --- packed columns ----------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers as compressed planes of bytes, after their number."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpack(blob: bytes, kind) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.Codec("zstd").decompress(blob[8:], decompressed_size=8 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).reshape(-1).view(kind)


def _pack_codes(code: np.ndarray) -> bytes:
    """Sorted codes by their differences."""
    return _pack(np.diff(code.astype(np.uint64), prepend=np.uint64(0)))


def _unpack_codes(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob, np.uint64), dtype=np.uint64)


def split(packed: DataFrame, depth: int, buckets: int = BUCKETS) -> DataFrame:
    """The packed grams of bundles, dealt to buckets: a row per bundle and bucket that has grams."""
    schema = pa.schema([("bundle", pa.string()), ("bucket", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                code, n = _unpack_codes(row["codes"]), _unpack(row["counts"], np.int64)
                bucket = _bucket(code, depth, buckets)
                order = np.argsort(bucket, kind="stable")
                edge = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
                parts = [order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True) if a < b]
                yield pa.RecordBatch.from_pylist([
                    {"bundle": row["bundle"], "bucket": int(bucket[at[0]]), "codes": _pack_codes(code[at]), "counts": _pack(n[at])} for at in parts], schema=schema)

    return packed.select("bundle", "codes", "counts").mapInArrow(run, "bundle string, bucket long, codes binary, counts binary")


def _summed(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of a bucket and their counts over all bundles.

    What waits is merged once it outgrows the merged grams, so memory goes
    with the distinct grams, not with the number of bundles.
    """
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for codes, n in zip(part["codes"], part["counts"], strict=True):
        keys.append(_unpack_codes(codes.as_py()))
        counts.append(_unpack(n.as_py(), np.int64))
        if sum(map(len, keys[1:])) > len(keys[0]) + (1 << 18):
            merged = _merged(keys, counts)
            keys, counts = [merged[0]], [merged[1]]
    return _merged(keys, counts)


# --- the tree ----------------------------------------------------------------

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5: recurrence up to 8 and more, then Stirling's series."""
    x, low = np.asarray(x, float), np.zeros(np.shape(x))
    for _ in range(8):
        small = x < 8
        low = low - np.where(small, np.log(np.where(small, x, 1.0)), 0.0)
        x = np.where(small, x + 1, x)
    r = 1 / (x * x)
    return low + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Block probability of n0 zeros and n1 ones under the KT estimator."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _mix(n0, n1, below):
    """log weighted probability of nodes, and the posterior weight of their own estimate."""
    own = log_kt(n0, n1)
    both = np.logaddexp(LN_HALF + own, LN_HALF + below)
    return both, np.exp(LN_HALF + own - both)


def subtree(code: np.ndarray, n: np.ndarray, depth: int, top: int = TOP) -> Iterator[list[dict]]:
    """For each bit in turn and each depth from ``top`` on: nodes with counts, weights
    and, per gram, the index of its node (``at``) and the bit it takes."""
    symbol = (code & np.uint64(255)).astype(np.int64)
    for k in range(8):
        node, bit = (1 << k) | (symbol >> (8 - k)), (symbol >> (7 - k)) & 1
        levels: list[dict] = []
        for d in range(top, depth + 1):
            context = (code >> np.uint64(8 * (depth + 1 - d))).astype(np.int64)
            key, at = np.unique((context << 8) | node, return_inverse=True)
            levels.append({"key": key, "at": at, "bit": bit, "n0": np.bincount(at, n * (1 - bit), len(key)), "n1": np.bincount(at, n * bit, len(key))})
        below = None
        for level, upper in zip(levels[::-1], [*levels[-2::-1], None], strict=True):
            if below is None:
                level["log"], level["weight"] = log_kt(level["n0"], level["n1"]), np.ones(len(level["key"]))
            else:
                level["log"], level["weight"] = _mix(level["n0"], level["n1"], below)
            if upper is not None:
                parent = np.searchsorted(upper["key"], (level["key"] >> 16 << 8) | (level["key"] & 255))
                below = np.bincount(parent, level["log"], len(upper["key"]))
        yield levels


def _estimate(level: dict) -> np.ndarray:
    """KT probability of the bit each gram takes at its node."""
    at = level["at"]
    n = np.where(level["bit"] == 1, level["n1"][at], level["n0"][at])
    return (n + 0.5) / (level["n0"][at] + level["n1"][at] + 1.0)


def roots(grams: DataFrame, depth: int) -> DataFrame:
    """Nodes at depth TOP: last (latest byte), node, n0, n1, log weighted probability."""
    def run(part: pa.Table) -> pa.Table:
        rows = []
        code, n = _summed(part)
        for levels in subtree(code, n.astype(float), depth):
            root = levels[0]
            rows.append(pa.table({"last": root["key"] >> 16, "node": root["key"] & 255, "n0": root["n0"], "n1": root["n1"], "log": root["log"]}))
        return pa.concat_tables(rows)

    return grams.groupBy("bucket").applyInArrow(run, "last long, node long, n0 double, n1 double, log double")


def _bucket(code: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    """A mix of all TOP latest context bytes; subtrees below them are independent."""
    with np.errstate(over="ignore"):
        mixed = (code >> np.uint64(8 * (depth + 1 - TOP))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def upper_nodes(root_nodes: DataFrame) -> np.ndarray:
    """(5, 256, 256): per latest byte and node the weight and estimates of the
    two depths above TOP.  At most 256 x 255 rows reach the driver, for any corpus."""
    rows = root_nodes.groupBy("last", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log").alias("log")).collect()
    n0, n1, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    for r in rows:
        n0[r["last"], r["node"]], n1[r["last"], r["node"]], below[r["last"], r["node"]] = r["n0"], r["n1"], r["log"]
    log, weight = _mix(n0, n1, below)
    top0, top1 = n0.sum(0), n1.sum(0)
    _, top = _mix(top0, top1, log.sum(0))
    wide = lambda x: np.broadcast_to(x, (256, 256))
    return np.stack([weight, (n1 + 0.5) / (n0 + n1 + 1.0), wide(top), wide((top1 + 0.5) / (top0 + top1 + 1.0)), n0 + n1])


def weigh(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per bundle and bucket the codes and, for each, the log10 probability of its symbol after its context."""
    upper = upper_nodes(roots(grams, depth))

    def run(part: pa.Table) -> pa.Table:
        code, n = _summed(part)
        last = (code >> np.uint64(8 * depth)).astype(np.int64)
        total = np.zeros(len(code))
        for levels in subtree(code, n.astype(float), depth):
            p = _estimate(levels[-1])
            for level in levels[-2::-1]:
                w = level["weight"][level["at"]]
                p = w * _estimate(level) + (1 - w) * p
            node, bit = levels[0]["key"][levels[0]["at"]] & 255, levels[0]["bit"]
            for w, one in ((upper[0], upper[1]), (upper[2], upper[3])):
                own = np.where(bit == 1, one[last, node], 1 - one[last, node])
                p = w[last, node] * own + (1 - w[last, node]) * p
            total += np.log10(p)
        log10 = [_pack(total[np.searchsorted(code, _unpack_codes(own.as_py()))]) for own in part["codes"]]
        return pa.table({"of": part["bundle"], "codes": part["codes"], "log10": pa.array(log10, pa.binary())})

    return grams.groupBy("bucket").applyInArrow(run, "of string, codes binary, log10 binary")


# --- scoring -----------------------------------------------------------------

def score(docs: DataFrame, depth: int = DEPTH, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    blobs = stored(spark, bundles(docs, bundle_bytes), "bundles")
    counts = stored(spark, count(blobs, depth).withColumn("kind", F.when(F.col("codes").isNull(), "word").otherwise("gram")), "counts", by="kind")
    codes, words = counts.where("kind = 'gram'"), counts.where("kind = 'word'")
    grams = int(codes.agg(F.sum("grams").alias("n")).first()["n"] or 0)
    log10 = weigh(split(codes, depth, max(BUCKETS, -(-grams // BUCKET_GRAMS))), depth)
    same = Window.partitionBy("word")
    known = words.select("bundle", "word", F.sum("n").over(same).alias("c"), (F.min("bundle").over(same) == F.col("bundle")).alias("one"))
    known = stored(spark, known, "known")
    total = known.agg(F.sum(F.when(F.col("one"), F.col("c"))).alias("n"), F.sum((F.col("one") & (F.col("c") > 0)).cast("long")).alias("v")).first()
    tokens, kinds = int(total["n"] or 0), int(total["v"] or 0)
    entries = known.select(F.col("bundle").alias("of"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("log10"), "word", "c")
    entries = entries.unionByName(log10.select("of", "codes", "log10", F.lit(None).cast("binary").alias("word"), F.lit(None).cast("long").alias("c")))

    def run(texts: pa.Table, own: pa.Table) -> pa.Table:
        coded = own.filter(pc.is_valid(own["codes"]))
        code = np.concatenate([_unpack_codes(x.as_py()) for x in coded["codes"]])
        value = np.concatenate([_unpack(x.as_py(), np.float64) for x in coded["log10"]])
        order = np.argsort(code)
        code, value = code[order], value[order]
        spelt = own.filter(pc.is_valid(own["word"]))
        names, c_of = spelt["word"].cast(pa.large_binary()).combine_chunks(), spelt["c"].to_numpy().astype(float)
        end_c = float(c_of[pc.index(names, pa.scalar(b"\xff", pa.large_binary())).as_py()])
        out = []
        for blob in texts["blob"]:
            for piece in _open(blob.as_py()):
                out.append(_scored(piece, code, value, names, c_of, end_c, depth))
        return pa.concat_tables(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double, bytes long"
    raw = blobs.groupBy("bundle").cogroup(entries.groupBy("of")).applyInArrow(
        lambda texts, own: run(texts, own) if texts.num_rows else _empty(), schema)
    return raw.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(tokens + kinds + 1)))).alias("base_score"),
        "score", (-F.col("score") / F.lit(float(np.log10(2))) / F.col("bytes")).alias("bits_per_byte"))


_RAW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                  ("log_counts", pa.float64()), ("score", pa.float64()), ("bytes", pa.int64())])


def _empty() -> pa.Table:
    return _RAW.empty_table()


def _scored(piece: pa.RecordBatch, code, value, names: pa.Array, c_of, end_c: float, depth: int) -> pa.Table:
    own, first, end = codes_of(piece["text"], depth)
    order = np.argsort(own)  # in order, the search walks the codes once instead of jumping
    at = np.empty(len(own), np.int64)
    at[order] = np.searchsorted(code, own[order])
    at[at == len(code)] = 0  # padding between texts, never summed
    log = np.concatenate([[0.0], np.cumsum(value[at] * (code[at] == own))])
    word, index, per = words_of(piece["text"])
    c = c_of[pc.index_in(word, value_set=names).fill_null(0).to_numpy()] if len(word) else np.zeros(0)
    real = (pc.binary_length(word).to_numpy() > 0) if len(word) else np.zeros(0, bool)
    edge = np.concatenate([[0], np.cumsum(per)])
    total = lambda x: (s := np.concatenate([[0.0], np.cumsum(x[index])]))[edge[1:]] - s[edge[:-1]]
    return pa.table([
        piece["doc_id"], piece["held_out"], pa.array((total(real * 1.0) + 1).round().astype(np.int64)),
        pa.array((total(real * (c > 0)) + (end_c > 0)).round().astype(np.int64)),
        pa.array(total(np.where(real, np.log10(c + 1), 0.0)) + np.log10(end_c + 1)),
        pa.array(log[end] - log[first]), pa.array(end - first)], schema=_RAW)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
