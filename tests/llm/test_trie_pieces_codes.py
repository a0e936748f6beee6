"""Prefix trie, SentencePiece pieces and vector codes against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from placetime.llm import codes, pieces, trie

TURNS = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- op11 --------------------------------------------------------------------

def trie_by_hand(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            digest = hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest()
            convs.setdefault(c, []).append(((t is not None, t or 0, digest), (r or "", x or "")))
    convs = {c: [b for _, b in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(made[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_conversations(seed):
    rng, rows = random.Random(seed), []
    for c in [*rng.sample(range(900), 90), 0, 100, 200]:
        for t in range(rng.choice([1, 2, 3, 5, 8, 30 if c % 50 == 0 else 4])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None, "a"]), rng.choice(["x", "y", None, "zz é🙂"])))
    rows += [(c, t, "u", f"same{t}") for c in range(5000, 5080) for t in range(3)]
    return [*rows, (None, 1, "u", "x"), (7, 1, "u", "x"), (7, 1, "u", "x"), (-5, 1, "u", "x")]


@pytest.mark.parametrize("block_turns", [9, 1 << 18])
def test_trie_against_brute_force(spark, block_turns):
    rows = some_conversations(block_turns)
    df = spark.createDataFrame(rows, TURNS)
    for name in ("index", "depth", "key", "lens", "block", "turns", "t", "donor", "head"):
        df = df.withColumn(name, F.lit("x"))
    assert rows_of(trie.prefix_trie(trie.rebuilt(df), block_turns)) == trie_by_hand(rows)


def test_trie_of_little(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(trie.rebuilt(none)).count() == 0
    # Its own turns all lie before h and its donor is absent: a conversation without turns is in the root alone.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    got = rows_of(trie.prefix_trie(trie.rebuilt(spark.createDataFrame([(c, 1, "u", "x")], TURNS))))
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    long_text = [(0, 1, "u", "é" * 300_000), (1, 1, "u", "b")]
    assert rows_of(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(long_text, TURNS)))) == trie_by_hand(long_text)


def test_minima():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 64, 65):
        v = rng.integers(0, 5, n)
        m = trie.Minima(v)
        a, b = np.array([(i, j) for i in range(n) for j in range(i, n)]).T
        assert m.least(a, b).tolist() == [v[i : j + 1].min() for i, j in zip(a, b, strict=True)]
        at, depth = np.array([(i, d) for i in range(n) for d in range(6)]).T
        right, left = m.right(at, depth), m.left(at, depth)
        for i, d, r, lo in zip(at, depth, right, left, strict=True):
            assert (v[i + 1 : r + 1] >= d).all() and (r == n - 1 or v[r + 1] < d)
            assert (v[lo + 1 : i + 1] >= d).all() and (lo == 0 or v[lo] < d)


# --- op12 --------------------------------------------------------------------

ODD = ["  a  b ", "", None, "a\n\tb", "ＡＢ é", "▁x y", " 　x", "a\0b", "<s>hi</s><0x0A>", "é", "日本語のテキストです。", "🙂🙂 x", " ", " " * 9,
       "\n" * 70, "a" * 5000, "x▁▁▁y", "ﬁ", "﻿a", "​", "▁", "▁▁a ▁", "Ça va? Où! «é», ñ. ß;", "x", "x"]


def test_pieces_are_the_librarys():
    agenda, rng = pieces.Agenda(pieces.default_model()), random.Random(1)
    agenda.MOST = 50  # the tables of chunks fill and change over
    texts = [t or "" for t in ODD] + ["".join(rng.choice("abe \n▁.,é日🙂<0xA>Ñ") for _ in range(rng.randrange(60))) for _ in range(2000)]
    own = [agenda.encode(t) for t in texts]
    theirs = agenda.library.encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in own] == theirs
    decoded = agenda.library.decode(theirs)
    assert all(agenda.agree(texts, own, decoded)) and agenda.guard
    # A wrong chunk and a wrong text are seen.
    agenda.unchecked = {"▁abc": b"\0\0\0\0"}
    assert agenda.agree(["abc", "x"], [b"", b""], ["abc", "y"]) == [False, False]


def test_pieces_query(spark, documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (5, "again"), (5, "again"), (99, "word " * 200_000)]
    lib = pieces.library(pieces.default_model())
    want = []
    for i, t in rows:
        ids = lib.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), True))
    docs = documents(rows).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(1))
    assert rows_of(pieces.digest(docs)) == sorted(want, key=repr)
    assert pieces.digest(docs.limit(0)).count() == 0
    encoded = pieces.encode(docs).withColumnRenamed("decoded", "was")
    back = pieces.decode(encoded.unionByName(encoded.limit(1).withColumn("ids", F.lit(None).cast("array<int>")).withColumn("was", F.lit(""))))
    assert back.where(~F.col("text").eqNullSafe(F.col("was"))).count() == 0


# --- op13 --------------------------------------------------------------------

def test_dual_tree_assignment():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n, d, k = int(rng.integers(1, 600)), int(rng.integers(1, 6)), int(rng.integers(1, 40))
        points, entries = rng.integers(-20, 20, (n, d)), rng.integers(-20, 20, (k, d))
        found = np.zeros(n, np.int64)
        count, total = codes.assign(points, codes.BoxTree(points, 8), entries, found)
        want = ((points[:, None] - entries) ** 2).sum(2).argmin(1)
        sums = np.zeros((k, d), np.int64)
        np.add.at(sums, want, points)
        assert (found == want).all() and (count == np.bincount(want, minlength=k)).all() and (total == sums).all()


def codes_by_hand(rows, entries, rounds):
    """Kept rows as (vec_id, code, error, label_error) and the codebooks; all vectors of one length."""
    real = [(i, label, [int(np.floor(1024 * x)) for x in v]) for i, v, label in rows if v is not None and None not in v and np.isfinite(v).all()]
    real.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    v = np.array([r[2] for r in real])
    books, found = [], []
    for part in np.split(v, 4, 1):
        book = part[:entries].copy()
        for r in range(rounds + 1):
            near = ((part[:, None] - book) ** 2).sum(2).argmin(1)
            for e in set(near.tolist()) if r < rounds else ():
                own = part[near == e]
                book[e] = own.sum(0) // len(own)
        books.append(book)
        found.append((near, ((part - book[near]) ** 2).sum(1)))
    code = ["".join(f"{x:02x}" for x in c) for c in zip(*(f[0].tolist() for f in found), strict=True)]
    error = sum(f[1] for f in found).tolist()
    by = {}
    for (_, label, _), e in zip(real, error, strict=True):
        by[label] = by.get(label, 0) + e
    return sorted([(i, c, e, by[label]) for (i, label, _), c, e in zip(real, code, error, strict=True)], key=repr), books


@pytest.mark.parametrize("broadcast", [True, False])
def test_codes_against_brute_force(spark, monkeypatch, broadcast):
    rng = np.random.default_rng(3)
    rows = [(int(i) if i % 50 else None, [float(x) for x in np.round(rng.normal(size=8), 2)], int(i) % 3 if i % 4 else None) for i in rng.permutation(700)]
    rows += [(7, rows[0][1], 1)] * 60 + [(3, None, 1), (4, [1.0, None] * 4, 1), (5, [float("nan")] * 8, 1), (6, [float("inf")] * 8, None), (8, [-0.0001] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("v", "e", "code", "error", "of", "salt", "packed"):
        df = df.withColumn(name, F.lit("x"))
    if not broadcast:
        monkeypatch.setattr(codes, "BROADCAST_LABELS", 0)
    coded, books = codes.compress(df, entries=20, rounds=3, block_rows=150)
    want, theirs = codes_by_hand(rows, 20, 3)
    assert rows_of(coded.select("vec_id", "code", "error", "label_error")) == want
    assert all((a == b).all() for a, b in zip(books, theirs, strict=True))


def test_codes_of_little_and_odd(spark):
    kind = "vec_id long, embedding array<double>, label int"
    assert codes.compress(spark.createDataFrame([], kind))[0].count() == 0
    rows = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0, 3.0, 4.0], 0), (3, [1e300, 0.0, 0.0, 0.0], 0), (4, [], None), (5, [1.0, 2.0, 3.0, 4.5], 0)]
    coded, books = codes.compress(spark.createDataFrame(rows, kind))
    assert rows_of(coded.select("vec_id", "code", "error")) == [(1, None, None), (2, "00000000", 0), (3, None, None), (4, None, None), (5, "00000001", 0)]
    assert [len(b) for b in books] == [2] * 4
