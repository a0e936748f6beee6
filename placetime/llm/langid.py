"""Language identification by a linear-chain conditional random field.

Method: every word is labelled.  Its emission scores come from hashed
features (affixes, byte n-grams with word boundaries, the whole word as a
lexicon entry, the same for its folded form), neighbouring labels are tied by
learned transitions, and forward-backward gives each word's label
distribution.  A text's language is the label with the largest expected number
of words, its score that label's share.  Code-switched texts are so labelled
word by word (``label_words``).

Training takes at most about ``SAMPLE_DOCS`` labelled documents, chosen by a
hash of doc_id evenly over the languages; sequences join pieces of different
documents so that switches are seen.  The model has a fixed size (features x
languages), so the closure that carries it to the tasks is bounded.  Scoring is
a narrow pass over all rows: no shuffle, no group.

Defined results: a null text, or one without a letter, is ``und`` with score
0; rows with a null lang teach nothing; a null doc_id counts as held out; with
no labelled rows every text is ``und``; repeated rows are scored row by row;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

HELD_OUT_OF = 5
SAMPLE_DOCS = 1000
FEATURES = 1 << 15
WIDTHS = (2, 3, 4)  # bytes of n-grams; a word has one byte more at each edge
EPOCHS, BATCH, PIECE, PIECES_PER_SEQUENCE = 3, 128, 16, 4
UNKNOWN = "und"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_OF == 0, F.lit(True))


# --- words and features ------------------------------------------------------

def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct folded words without outer punctuation, index of each occurrence, words per text."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(text))
    flat = pc.ascii_trim(pc.list_flatten(split), PUNCTUATION)
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), pc.list_value_length(split).to_numpy().astype(np.int64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint32)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64) % FEATURES


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all bytes of each word: the word of each feature, and the feature's id.

    The n-grams of a word with its edges (those that hold an edge are the
    affixes), and the whole word as a lexicon entry.  An empty word has none.
    """
    raw = words.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    size = size[full]
    if not len(full):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8)
    start = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(start, size)
    inner = data[np.repeat(offsets[:-1][full], size) + place]
    # All words in a row, each with 1 before and 2 behind it.
    edged = np.zeros(len(inner) + 2 * len(full), np.uint32)
    first = start + 2 * np.arange(len(full))
    edged[first], edged[first + size + 1] = 1, 2
    edged[np.repeat(first, size) + 1 + place] = inner
    left = np.repeat(first + size + 2, size + 2) - np.arange(len(edged))  # bytes up to the word's end
    owner = np.repeat(full, size + 2)
    of_word, ids = [], []
    for width in WIDTHS:
        at = np.flatnonzero(left >= width)
        h = np.full(len(at), 977 * width, np.uint32)
        for k in range(width):
            h = (h ^ edged[at + k]) * np.uint32(0x01000193)
        of_word.append(owner[at])
        ids.append(_mixed(h))
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()) - 1, np.uint64(0x100000001B3))]))
    whole = np.add.reduceat((inner.astype(np.uint64) + np.uint64(1)) * powers[place], start) ^ size.astype(np.uint64)
    of_word.append(full)
    ids.append(_mixed(whole ^ (whole >> np.uint64(32))))
    return np.concatenate(of_word), np.concatenate(ids)


# --- the chain ---------------------------------------------------------------

def forward_backward(emit: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised forward and backward messages and word marginals.

    ``emit``: positive scores (words x labels), texts one after another;
    ``moves``: positive transition scores.  All texts advance together,
    longest first, so a step is one small matrix product.
    """
    first = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    first, size = first[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    ahead, back = np.empty_like(emit), np.empty_like(emit)
    a = np.ones((len(size), emit.shape[1]), emit.dtype)
    for t in range(longest):
        at = first[: active[t]] + t
        a = a[: active[t]]
        a = (a @ moves if t else a) * emit[at]
        a /= a.sum(1, keepdims=True)
        ahead[at] = a
    b = np.ones((len(size), emit.shape[1]), emit.dtype)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        more = active[t + 1] if t + 1 < longest else 0
        if more:
            nxt = (emit[at[:more] + 1] * b[:more]) @ moves.T
            b[:more] = nxt / nxt.sum(1, keepdims=True)
        back[at] = b[:k]
    both = ahead * back
    return ahead, back, both / both.sum(1, keepdims=True)


def _summed(weights: np.ndarray, of_word: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Weights of each word's features, added up."""
    return np.stack([np.bincount(of_word, weights[ids, y], n) for y in range(weights.shape[1])], 1) if weights.shape[1] else np.zeros((n, 0))


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray  # FEATURES x labels
    moves: np.ndarray  # labels x labels, log scale

    def emission(self, words: pa.Array) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for k in range(0, len(words), 20_000):
            some = words[k : k + 20_000]
            out[k : k + 20_000] = _summed(self.weights, *features(some), len(some))
        return out

    def marginals(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label distributions of all words, whether a word has letters, words per text."""
        words, at, per = split_words(text)
        if not len(at):
            return np.zeros((0, len(self.labels))), np.zeros(0, bool), per
        score = self.emission(words)
        score = np.exp(np.clip(score - score.max(1, keepdims=True), -30, 0))
        lettered = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
        score[~lettered] = 1
        moves = np.exp(self.moves).astype(np.float32)
        return forward_backward(score[at], moves, per)[2], lettered[at], per


# --- training ----------------------------------------------------------------

def sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """About ``sample_docs`` labelled texts, as many of each language as there are, by hash of doc_id."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_docs // 2).collect()}
    if not sizes:
        return []
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / len(sizes) / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    found = rows.where(draw < share).select("text", "lang", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample_docs)
    return [(r["text"], r["lang"]) for r in found.collect()]


def fit(examples: list[tuple[str, str]], seed: int = 7) -> Model:
    """Adagrad on the conditional likelihood of word labels."""
    labels = tuple(sorted({lang for _, lang in examples}))
    size = len(labels)
    weights, moves = np.zeros((FEATURES, size), np.float32), np.zeros((size, size))
    if not examples:
        return Model((), weights, moves)
    words, at, per = split_words(pa.array([t for t, _ in examples], pa.large_string()))
    of_word, ids = features(words)
    by_word = np.argsort(of_word, kind="stable")
    ids = ids[by_word]
    many = np.bincount(of_word, minlength=len(words))
    start = np.cumsum(many) - many
    of_doc = np.array([labels.index(lang) for _, lang in examples])
    edges = np.concatenate([[0], np.cumsum(per)])
    pieces = [(of_doc[d], p, min(p + PIECE, edges[d + 1])) for d in range(len(per)) for p in range(edges[d], edges[d + 1], PIECE)]
    rng = np.random.default_rng(seed)
    sum_w, sum_m = np.full((FEATURES, size), 1e-6, np.float32), np.full((size, size), 1e-6)
    full = np.zeros((FEATURES, size), np.float32)
    for _ in range(EPOCHS):
        # Half of the sequences keep neighbouring pieces, the others switch at random.
        order = np.arange(len(pieces))
        groups = [order[k : k + PIECES_PER_SEQUENCE] for k in range(0, len(order), PIECES_PER_SEQUENCE)]
        mixed = [g for g in groups if rng.random() < 0.5]
        if mixed:
            pool = rng.permutation(np.concatenate(mixed))
            keep = {id(g) for g in mixed}
            groups = [g for g in groups if id(g) not in keep] + [pool[k : k + PIECES_PER_SEQUENCE] for k in range(0, len(pool), PIECES_PER_SEQUENCE)]
        rng.shuffle(groups)
        for k in range(0, len(groups), BATCH):
            chosen = groups[k : k + BATCH]
            spans = [[pieces[i] for i in g] for g in chosen]
            word = np.concatenate([at[a:b] for g in spans for _, a, b in g])
            truth = np.concatenate([np.full(b - a, y) for g in spans for y, a, b in g])
            lengths = np.array([sum(b - a for _, a, b in g) for g in spans])
            used, local = np.unique(word, return_inverse=True)
            # The features of the words of this batch.
            has = many[used]
            own = ids[np.repeat(start[used] - (np.cumsum(has) - has), has) + np.arange(int(has.sum()))]
            of_used = np.repeat(np.arange(len(used)), has)
            score = _summed(full, of_used, own, len(used))[local]
            emit = np.exp(np.clip(score - score.max(1, keepdims=True), -30, 0)).astype(np.float64)
            ahead, back, marginal = forward_backward(emit, np.exp(moves), lengths)
            off = -marginal
            off[np.arange(len(truth)), truth] += 1
            per_word = np.stack([np.bincount(local, off[:, y], len(used)) for y in range(size)], 1)
            touched, inverse = np.unique(own, return_inverse=True)
            grad = np.stack([np.bincount(inverse, per_word[of_used, y], len(touched)) for y in range(size)], 1) / len(word)
            sum_w[touched] += grad**2
            full[touched] += (0.1 * grad / np.sqrt(sum_w[touched])).astype(np.float32)
            starts = np.cumsum(lengths) - lengths
            later = np.ones(len(word), bool)
            later[starts] = False
            nxt = np.flatnonzero(later)
            pair = ahead[nxt - 1][:, :, None] * np.exp(moves) * (emit[nxt] * back[nxt])[:, None, :]
            expected = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
            seen = np.zeros((size, size))
            np.add.at(seen, (truth[nxt - 1], truth[nxt]), 1)
            g = (seen - expected) / max(1, len(nxt))
            sum_m += g**2
            moves = moves + 0.2 * g / np.sqrt(sum_m)
    return Model(labels, full, moves)


# --- scoring -----------------------------------------------------------------

def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and words per language (a map) of every row."""
    names = list(model.labels)
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
                     ("words", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for some in text_slices(batch, 6 << 20):
                text = some["text"].cast(pa.large_string()).fill_null("")
                known = pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False)
                total = np.zeros((len(text), len(names)))
                if names:
                    share, lettered, per = model.marginals(text)
                    sums = np.concatenate([np.zeros((1, len(names))), np.cumsum(share * lettered[:, None], 0, dtype=np.float64)])
                    edge = np.concatenate([[0], np.cumsum(per)])
                    total = np.maximum(sums[edge[1:]] - sums[edge[:-1]], 0)
                every = total.sum(1)
                known &= every > 0
                best = total.argmax(1) if names else np.zeros(len(text), int)
                score = np.where(known, total[np.arange(len(text)), best] / np.where(every > 0, every, 1), 0.0) if names else np.zeros(len(text))
                yield pa.RecordBatch.from_arrays([
                    some["doc_id"], some["held_out"],
                    pa.array([names[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), known.tolist(), strict=True)], pa.string()),
                    pa.array(np.clip(score, 0, 1)), pa.array(total.tolist(), pa.list_(pa.float64()))], schema=out)

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    found = rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, words array<double>")
    keys = F.array(*[F.lit(x) for x in names]) if names else F.array().cast("array<string>")
    return found.withColumn("words", F.map_from_arrays(keys, "words"))


def label_words(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(word, language, probability) of each word of one text, for code-switched text; words part at ASCII blanks."""
    arr = pa.array([text], pa.large_string())
    share, _, _ = model.marginals(arr)
    pieces = pc.list_flatten(pc.ascii_split_whitespace(arr)).to_pylist()
    return [(w, model.labels[int(p.argmax())], float(p.max())) for w, p in zip(pieces, share, strict=True) if w]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(sample(docs))).select("doc_id", "held_out", "lang_pred", "score")
