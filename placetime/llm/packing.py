"""Best-fit packing of tokenized documents into fixed-length sequences.

Method: pieces above a third of the capacity pair at most twice per sequence
by greedy matching (the longest left with the longest that still fits);
smaller pieces then go, longest first, to the sequence with the smallest gap
that holds them.

Only a piece's length matters for packing, so the matching runs on the
histogram of lengths, which has at most ``capacity`` entries whatever the
size of the corpus.  Its result is a list of runs "the pieces of length L with
ranks a to b go to sequences s, s+1, ... at offset o", also independent of the
number of documents.  Ranks need no sort: a tokenizing task numbers its own
pieces per length, and the counts of earlier tasks are added afterwards.

Defined results: a null or empty text is the one id 0; ids follow the order of
the text; repeated rows are packed one by one; other columns are ignored.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_slices

CAPACITY = 2048
ALNUM = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
PIECES = "doc_id long, piece int, start long, length long, ids binary, part long, nth long"
RUNS = "run_length long, first_rank long, end_rank long, first_sequence long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Ids:
    """Ids of blank-free chunks as little-endian bytes.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its chunks in order, and equal chunks are encoded once.
    New chunks are encoded many at a time, joined by blanks; each id goes to
    the chunk that holds its first character.  A chunk that only adds final
    stops and commas to a word takes the word's ids.  Chunks of letters alone
    are told apart by the ids that end a word.  Chunks met lately are in
    two tables of bounded size: one in use moves to the younger, and when that is
    full it becomes the older, whose rest goes; this changes no result.
    """

    MOST, JOINED = 500_000, 256

    def __init__(self, path: str):
        # A task has one core, and threads of its own would only leave it scattered memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.younger: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        # Whether an id ends a word.
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def ids(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk."""
        if len(self.younger) > self.MOST:
            self.younger, self.older = {}, self.younger
        known = self.younger
        known[b""] = b""
        cut, wanted = [], {}
        for c in self._new(chunks):
            s = c.rstrip(b".,")
            if len(s) < len(c) and s and s[-1] in ALNUM:
                cut.append((c, s, c[len(s) :]))
            else:
                wanted[c] = None
        for _, s, stops in cut:
            wanted[s] = wanted[stops] = None
        words, others = [], []
        for w in self._new(wanted):
            (words if w.isalpha() else others).append(w)
        self._encode(others + self._encode_words(words))
        for c, s, stops in cut:
            known[c] = known[s] + known[stops]
        return [known[c] for c in chunks]

    def _new(self, chunks: Iterable[bytes]) -> list[bytes]:
        """The chunks that neither table holds; those of the older one move."""
        known, older = self.younger, self.older
        new = [c for c in chunks if c not in known]
        if not older:
            return new
        known.update((c, older[c]) for c in new if c in older)
        return [c for c in new if c not in older]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """As ``_encode``, for chunks of ASCII letters alone: where each is one word of the tokenizer, ids that end
        a word tell them apart and no offsets are needed.  Returns the words that could not be told apart."""
        if not self.ends_word.any():
            return words
        left, step = [], 64 * self.JOINED
        for some in (words[k : k + step] for k in range(0, len(words), step)):
            texts = [b" ".join(some[k : k + self.JOINED]).decode() for k in range(0, len(some), self.JOINED)]
            ids = np.array([i for f in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in f.ids], "<u4")
            raw, at = ids.tobytes(), 0
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) != len(some):
                left += some
                continue
            for word, end in zip(some, ends.tolist(), strict=True):
                self.younger[word], at = raw[at:end], end
        return left

    def _encode(self, chunks: list[bytes]) -> None:
        groups = [chunks[k : k + self.JOINED] for k in range(0, len(chunks), self.JOINED)]
        for k in range(0, len(groups), 64):
            texts = [b" ".join(g).decode() for g in groups[k : k + 64]]
            for group, text, found in zip(groups[k : k + 64], texts, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                starts = np.cumsum([0, *[len(x) + 1 for x in text.split(" ")]])[:-1]
                ids = np.array(found.ids, "<u4")
                first = np.array([a for a, _ in found.offsets], np.int64)
                ends = np.bincount(np.searchsorted(starts, first, "right") - 1, minlength=len(group)).cumsum() * 4
                raw, at = ids.tobytes(), 0
                for chunk, end in zip(group, ends.tolist(), strict=True):
                    self.younger[chunk], at = raw[at:end], end

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text ends.  ASCII
        letters fold first, as the tokenizer does, unless a text may hold one
        of its (case-sensitive) special tokens."""
        texts = texts.cast(pa.large_string()).fill_null("")
        folded = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(folded)
        coded = pc.list_flatten(split).dictionary_encode()
        taken = pa.array(self.ids(_values(coded.dictionary)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u4")[: ends[-1]]
        return ids, ends[np.cumsum(pc.list_value_length(split).to_numpy())]


def _values(strings: pa.Array) -> list[bytes]:
    """The bytes of each of some large strings."""
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1].tolist()
    raw = strings.buffers()[2].to_pybytes() if strings.buffers()[2] else b""
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


_LOADED: dict[str, Ids] = {}


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids; part and nth number them within their task and length."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("part", pa.int64()), ("nth", pa.int64())])
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        if path not in _LOADED:
            _LOADED[path] = Ids(path)
        seen, part = defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            for some in text_slices(batch, 4 << 20):
                flat, ends = _LOADED[path].of(some["text"])
                rows, first = [], 0
                for doc_id, last in zip(some["doc_id"].to_pylist(), ends.tolist(), strict=True):
                    ids, first = flat[first:last].tobytes() + end, last
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc_id, k, at // 4, n, own, part, seen[n]))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, offset) for pieces of given lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank: dict[int, int] = defaultdict(int)
    lengths = sorted(left)
    open_at: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
    gaps: list[int] = []
    runs, sequences = [], 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, rank[length], rank[length] + n, first, offset))
        rank[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if not open_at[gap]:
                insort(gaps, gap)
            open_at[gap].append((first, n))

    large = [n for n in lengths if 3 * n > capacity]
    for length in reversed(large):
        while left[length]:
            at = bisect_left(large, min(length, capacity - length) + 1) - 1
            while at >= 0 and left[large[at]] < 1 + (large[at] == length):
                at -= 1
            partner = large[at] if at >= 0 else 0
            n = min(left[length] // 2 if partner == length else left[length], left[partner]) if partner else left[length]
            place(length, n, sequences, 0)
            if partner:
                place(partner, n, sequences, length)
            leave(capacity - length - partner, sequences, n)
            sequences += n
    for length in reversed([n for n in lengths if 3 * n <= capacity]):
        while left[length]:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, many = open_at[gap].pop()
                n = min(many, left[length])
                if n < many:
                    open_at[gap].append((first + n, many - n))
                if not open_at[gap]:
                    gaps.pop(at)
                place(length, n, first, capacity - gap)
                leave(gap - length, first, n)
                continue
            each = min(capacity // length, left[length])
            n = left[length] // each
            for k in range(each):
                place(length, n, sequences, k * length)
            leave(capacity - each * length, sequences, n)
            sequences += n
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a stored table with length, part and nth."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(spark, counts.withColumnRenamed("part", "of_part").withColumnRenamed("length", "of_length"), "lengths")
    histogram = {r["of_length"]: r["n"] for r in counts.groupBy("of_length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(pack_histogram(histogram, capacity), RUNS)
    before = Window.partitionBy("of_length").orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("of_part", "of_length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("of_length")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth")).drop("of_part", "of_length", "base", "part", "nth")
    # The runs depend on the capacity alone (see pack_histogram), so this side is bounded.
    held = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    out = ranked.join(F.broadcast(runs), held)
    return out.withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank")).drop(
        "run_length", "first_rank", "end_rank", "first_sequence", "rank")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    pieces = stored(docs.sparkSession, tokenize(docs, path or default_tokenizer(), capacity), "pieces")
    return place(pieces, capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def digest(docs: DataFrame) -> DataFrame:
    """The packed pieces with a checksum instead of their ids, from the table that holds the ids."""
    packed = pack(docs).withColumn("ids_crc32", F.crc32("ids"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
