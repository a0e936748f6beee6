"""SentencePiece encoding and decoding for merge-type vocabularies.

Method: a text is normalised, cut into characters, and an agenda (a heap) holds
every adjacent pair of symbols whose join is a piece, best score first and
leftmost first among equals.  Taking a pair joins its symbols, and the two new
neighbours enter the agenda; entries of symbols that have changed since are
passed over.  What is left is looked up, and a symbol outside the vocabulary
becomes its UTF-8 bytes.

No pair joins where no piece of the vocabulary holds the two characters side by
side, so words, and the stops behind them, are chunks that merge on their own.
Chunks repeat, and a worker keeps those it has met lately in two tables of
bounded size: a chunk in use moves to the younger one, and when that is full it
becomes the older one, whose rest goes (results do not depend on it).

Every Arrow batch is checked against the sentencepiece library: it encodes all
chunks that were merged for the batch, behind a character that joins nothing,
and decodes all ids, which must give the normalised texts again.  ``agrees`` says
whether a text and all its chunks pass.  Where the vocabulary has no such
character, the library encodes whole texts.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows are encoded one by one; other columns are ignored; a vocabulary
with unused pieces, which the merge would have to undo, is refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

BLANK = "▁"
#: Bytes of text handled at once.
SLICE = 2 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def library(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


class Agenda:
    """Encodes normalised text by merging symbol pairs in the order of their scores."""

    MOST, LONGEST = 500_000, 64

    def __init__(self, model: str):
        lib = self.library = library(model)
        size = lib.vocab_size()
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError(f"{model} has unused pieces")
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.id = {lib.id_to_piece(i): i for i in plain}
        #: rank of a piece's score, best first; equal scores share one
        places = {score: k for k, score in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        self.rank = {piece: places[lib.get_score(i)] for piece, i in self.id.items()}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(lib.is_byte(i) for i in self.byte)
        self.unknown = lib.unk_id()
        behind: dict[str, set[str]] = {}
        for piece in self.id:
            for a, b in zip(piece, piece[1:], strict=False):
                behind.setdefault(b, set()).add(a)
        self.chunks = re.compile(self._chunks(behind))
        #: a character that joins nothing, and its ids at the start of a text
        ahead = set().union(*behind.values()) if behind else set()
        free = [c for c in "\n\t\v\f" if self.fallback and c not in behind and c not in ahead and lib.normalize("a" + c).endswith(c)]
        self.guard, self.guard_ids = (free[0], lib.encode(free[0])) if free else ("", [])
        self.prefix = BLANK if lib.normalize("a").startswith(BLANK) else ""
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.unchecked: dict[str, bytes] = {}
        self.wrong: set[str] = set()

    def _chunks(self, behind: dict[str, set[str]]) -> str:
        """A pattern of chunks, cut only where no piece holds the two characters side by side: before a
        blank and around Latin characters other than plain letters and digits, as far as the vocabulary allows."""
        if not self.fallback or behind.get(BLANK, set()) - {BLANK}:  # runs of unknown symbols cross cuts
            return "(?s).+"
        rare = "".join(c for c in map(chr, range(0x250)) if not (c.isascii() and c.isalnum()))
        rest = [f"{re.escape(c)}(?<=[{''.join(map(re.escape, sorted(behind[c])))}]{re.escape(c)})" for c in rare if c in behind]
        return f"(?s:{BLANK}+|[^{BLANK}])(?:{'|'.join([f'[^{BLANK}{re.escape(rare)}]+', *rest])})*"

    def merge(self, text: str) -> list[str]:
        """The pieces of one chunk.  An agenda entry is a pair's rank and its left symbol's place, as one number."""
        symbols, n, rank = list(text), len(text), self.rank.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [r << 32 | k for k, r in enumerate(map(rank, map(add, text, text[1:]))) if r is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            right, a = after[left], symbols[left]
            if not a or right == n or rank(joined := a + symbols[right]) != entry >> 32:
                continue  # one of the two symbols has changed
            symbols[left], symbols[right] = joined, ""
            follows, leads = after[right], before[left]
            after[left] = follows
            if follows < n:
                before[follows] = left
                if (r := rank(joined + symbols[follows])) is not None:
                    heappush(agenda, r << 32 | left)
            if leads >= 0 and (r := rank(symbols[leads] + joined)) is not None:
                heappush(agenda, r << 32 | leads)
        return [s for s in symbols if s]

    def ids(self, pieces: list[str]) -> Iterator[int]:
        last_unknown = False
        for p in pieces:
            found = self.id.get(p)
            if found is not None:
                yield found
            elif self.fallback:
                yield from (self.byte[b] for b in p.encode())
            elif not last_unknown:  # the library writes a run of unknown symbols as one id
                yield self.unknown
            last_unknown = found is None

    def chunk(self, text: str) -> bytes:
        """Ids of a chunk that is not in the younger table, as little-endian 32-bit integers."""
        got = self.older.get(text)
        if got is None:
            got = array("i", self.ids(self.merge(text))).tobytes()
            if self.guard:
                self.unchecked[text] = got
        if len(text) <= self.LONGEST:
            if len(self.known) >= self.MOST:
                self.known, self.older = {}, self.known
            self.known[text] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        return b"".join([self.known.get(c) or self.chunk(c) for c in self.chunks.findall(self.library.normalize(text))])

    def agree(self, texts: list[str], ids: list[bytes], decoded: list[str]) -> list[bool]:
        """Whether the library agrees with the ids of each text."""
        if not self.guard:
            return [array("i", x).tobytes() == own for x, own in zip(self.library.encode(texts, num_threads=1), ids, strict=True)]
        theirs = self.library.encode([self.guard + c.replace(BLANK, " ") for c in self.unchecked], num_threads=1)
        lead = array("i", self.guard_ids).tobytes()
        self.wrong.update(c for (c, own), x in zip(self.unchecked.items(), theirs, strict=True) if array("i", x).tobytes() != lead + own)
        self.unchecked = {}
        whole = [self.library.normalize(t) for t in texts]
        same = [w.removeprefix(self.prefix).replace(BLANK, " ") == d for w, d in zip(whole, decoded, strict=True)]
        return [s and self.wrong.isdisjoint(self.chunks.findall(w)) for s, w in zip(same, whole, strict=True)] if self.wrong else same


@lru_cache(maxsize=1)
def worker_agenda(model: str) -> Agenda:
    """One table of known chunks for all tasks of a Python worker."""
    return Agenda(model)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from text_slices(batch, SLICE)


def encode(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), decoded (the library's text of the ids), agrees."""
    path = model or default_model()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = worker_agenda(path)
        for batch in _slices(batches):
            texts = batch["text"].to_pylist()
            own = [agenda.encode(t) for t in texts]
            decoded = agenda.library.decode([np.frombuffer(x, "<i4").tolist() for x in own], num_threads=1)
            agrees = agenda.agree(texts, own, decoded)
            ends = np.cumsum([0, *(len(x) // 4 for x in own)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(own), "<i4")))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids, pa.array(decoded, pa.string()), pa.array(agrees)],
                                             names=["doc_id", "ids", "decoded", "agrees"])

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, ids array<int>, decoded string, agrees boolean")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The table with ``text``, the library's text of ``ids`` (no ids or null: empty)."""
    path = model or default_model()
    kept = [c for c in encoded.columns if c != "text"]
    names = [*kept, "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = None
        for batch in batches:
            lib = lib or library(path)
            step = max(1, SLICE * batch.num_rows // max(1, batch.nbytes))
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                ids = part["ids"].fill_null([]) if part["ids"].null_count else part["ids"]
                flat, ends = ids.flatten().to_numpy().tolist(), np.cumsum([0, *pc.list_value_length(ids).to_pylist()])
                texts = lib.decode([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], num_threads=1)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(texts, pa.string())], names=names)

    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept)
    return encoded.select(*kept).mapInArrow(run, f"{schema}, text string")


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""
    return encode(docs, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
