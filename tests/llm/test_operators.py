"""Each operator against a brute-force version, and on edge cases."""

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placetime.llm import common, ctw, graph, jaccard, langid, mixing, packing, pii, quality, toolcalls, topk, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE_TEXTS = [None, "", " \n\t ", "a", "a b c d", "x" * 5000, "same words here now again " * 3, "é ß 漢字 𝒳", "1.2.3.4.5.6.7.8 +1 (234) 555-6789"]


def rows_of(df, *cols):
    return [tuple(r[c] for c in (cols or df.columns)) for r in df.collect()]


# --- op1 ---------------------------------------------------------------------

BASE = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in p.finditer(text or "") if ok(m[0])]


def check_pii(docs, texts):
    out = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for i, t in enumerate(texts):
        assert [(x["kind"], x["start"], x["end"]) for x in out[i]["base"]] == base_spans(t), t


def test_pii_edges(documents):
    card = "4111111111111111"
    texts = [*EDGE_TEXTS, "a@b.c_d@e.f", "a@b..c x@y.z. q@r", "a@b@c.d", "x@a.b-.c, .@-.-", "1.2.3", "256.1.1.1 0.0.0.0 001.2.3.255", card,
             f"{card[:4]} {card[4:8]}-{card[8:12]} {card[12:]}", f"{card}  {card}", f"1{card}", f"9 {card}", f"{card}-", "+1((((2 +12345678", "++1234 5678 90",
             "𝒳 é a@b.co 𝒳 1.1.1.1", "+1 23+4567 89012345 6", "1" * 20000, "a" * 20000 + "@" + "b." * 3000, "1 2 " * 4000, "1." * 4000, "+1" + "-" * 5000]
    check_pii(documents(list(enumerate(texts))), texts)


def test_pii_random(documents):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789 .-+@ab()%\n") for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("01.@a-+ ") for _ in range(80)) for _ in range(700)]
    check_pii(documents(list(enumerate(texts))), texts)


def test_pii_of_a_long_text_with_many_spans(spark, documents):
    """A million characters of phones cost about what their length does; blocks and context stay right."""
    import time

    phones = "".join(f"+1 555 {i % 1000:03d} 4567 " for i in range(58_000))
    mixed = "".join(f"é🙂 card 4111 1111 1111 {1111 + i % 3} mail a{i}@b.org, ip 10.0.0.{i % 300} tel +49 30 {100000 + i} " for i in range(700))
    began = time.monotonic()
    assert pii.find(documents([(0, phones)])).select(F.size("base")).first()[0] == 58_000
    assert pii.redact(documents([(0, phones)])).first()["text"] == "[PHONE] " * 58_000
    assert time.monotonic() - began < 60
    check_pii(documents([(0, mixed)]), [mixed])
    spans = pii.find(documents([(0, mixed)])).first()
    want, at = [], 0
    for x in sorted([*spans["base"], *spans["more"]], key=lambda x: (x["start"], -x["end"])):
        if x["start"] >= at:
            want += [mixed[at : x["start"]], f"[{x['kind'].upper()}]"]
        at = max(at, x["end"])
    assert pii.redact(documents([(0, mixed)])).first()["text"] == "".join(want) + mixed[at:]


def test_pii_added_spans_and_redaction(documents):
    iban = "GB82 WEST 1234 5698 7654 32"
    texts = [f"pay to {iban} now", "GB83WEST12345698765432", "ssn 123-45-6789", "code 123-45-6789", "call (555) 555-1234 or a@b.co", "x (555) 555-1234", None]
    found = {r["doc_id"]: [x["kind"] for x in r["more"]] for r in pii.find(documents(list(enumerate(texts)))).collect()}
    assert found == {0: ["iban"], 1: [], 2: ["national_id"], 3: [], 4: ["local_phone"], 5: [], 6: []}
    red = documents(list(enumerate(texts)), extra=False)
    out = {r["doc_id"]: r for r in pii.redact(red).collect()}
    assert out[0]["text"] == "pay to [IBAN] now" and out[0]["n_chars"] == 17
    assert out[4]["text"] == "call [LOCAL_PHONE] or [EMAIL]" and out[6]["text"] is None and out[1]["text"] == texts[1]
    assert pii.redact(red).columns == red.columns


def test_pii_query(spark):
    out = {r["doc_id"]: r for r in pii.query(spark, SF).collect()}
    for r in common.table(spark, SF, "documents").collect():
        spans = base_spans(r["text"])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        got = out[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in spans) for k in BASE]
        assert got["spans"].startswith(joined)


# --- op2 ---------------------------------------------------------------------

def test_langid_held_out(spark):
    out = {r["doc_id"]: r for r in langid.query(spark, SF).collect()}
    docs = common.table(spark, SF, "documents").collect()
    assert len(out) == len(docs)
    right = []
    for r in docs:
        got = out[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= got["score"] <= 1
        if got["held_out"] and r["lang"] and any(c.isalpha() for c in r["text"] or ""):
            right.append(got["lang_pred"] == r["lang"])
    assert sum(right) >= 0.95 * len(right) > 0


def test_langid_edges_and_switching(spark, documents):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["der und die nicht ein", "the and of that with"] * 30)]
    model = langid.fit([(t, lang) for _, t, lang in rows])
    docs = documents(list(enumerate([*EDGE_TEXTS, "123 456 !!", "the of"])))
    out = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert out[0]["lang_pred"] == out[1]["lang_pred"] == out[2]["lang_pred"] == out[9]["lang_pred"] == "und"
    assert out[10]["lang_pred"] == "en" and out[10]["score"] > 0.6
    labels = [x[1] for x in langid.label_words("der und die nicht the and of that with", model)]
    assert labels == ["de"] * 4 + ["en"] * 5
    assert [x[:2] for x in langid.label_words(" \u00a0the  und ", model)] == [("\u00a0the", "en"), ("und", "de")]
    nobody = langid.identify(docs, langid.fit([])).collect()
    assert {r["lang_pred"] for r in nobody} == {"und"} and {r["score"] for r in nobody} == {0.0}
    assert langid.identify(docs.limit(0), model).count() == 0 and langid.sample(docs.withColumn("lang", F.lit(None).cast("string"))) == []


def plain_features(word):
    """Feature ids of a word, feature by feature."""
    b, found = word.encode(), []
    mix = lambda h: (((h ^ (h >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17) % langid.FEATURES
    edged = [1, *b, 2]
    for width in langid.WIDTHS if b else ():
        for k in range(len(edged) - width + 1):
            h = 977 * width
            for x in edged[k : k + width]:
                h = (h ^ x) * 0x01000193 & 0xFFFFFFFF
            found.append(mix(h))
    if b:
        whole = sum((x + 1) * pow(0x100000001B3, k, 2**64) for k, x in enumerate(b)) % 2**64 ^ len(b)
        found.append(mix((whole ^ (whole >> 32)) & 0xFFFFFFFF))
    return sorted(found)


def test_langid_reads_whole_words():
    words = ["a", "", "the", "été", "x" * 32, "x" * 16 + "y" + "x" * 15, "日本語のテキスト" * 40, "z" * 100_000]
    of_word, ids = langid.features(pa.array(words, pa.large_string()))
    got = [sorted(ids[of_word == i].tolist()) for i in range(len(words))]
    assert got[:7] == [plain_features(w) for w in words[:7]] and got[4] != got[5] and len(got[7]) == 100_001 + 100_000 + 99_999 + 1
    assert all(len(x) == 0 for x in langid.features(pa.array(["", ""], pa.large_string())))


def test_langid_against_plain_forward_backward(spark, documents):
    """Every text scored word by word in plain Python; repeated rows and a word of a whole sentence."""
    rng = random.Random(4)
    lexicon = {"en": "the of and that with this".split(), "de": "der und nicht ein aber wenn".split(), "fr": "que les dans nous être".split()}
    model = langid.fit([(" ".join(rng.choices(words, k=12)), lang) for lang, words in lexicon.items() for _ in range(25)])
    texts = [" ".join(rng.choices(lexicon[rng.choice(list(lexicon))], k=3) + rng.choices(lexicon["de"], k=rng.randrange(4))) for _ in range(25)]
    texts += [texts[0], texts[0], "the 12 und !", "thedermitdiesenundvielenwortenohneeinleerzeichen", "日本語の 的文章"]
    out = langid.identify(documents([(i // 2, t) for i, t in enumerate(texts)]), model)
    names, moves = model.labels, np.exp(model.moves)
    want = []
    for i, text in enumerate(texts):
        emit = []
        for w in text.lower().split(" "):
            w = w.strip(langid.PUNCTUATION)
            score = np.sum([model.weights[f] for f in plain_features(w)], axis=0) if w and any(c.isalpha() for c in w) else np.zeros(len(names))
            emit.append((np.exp(np.clip(score - score.max(), -30, 0)), any(c.isalpha() for c in w)))
        total = np.zeros(len(names))
        ahead = [emit[0][0]]
        for e, _ in emit[1:]:
            ahead.append((ahead[-1] @ moves) * e)
        back = [np.ones(len(names))]
        for e, _ in reversed(emit[1:]):
            back.insert(0, moves @ (e * back[0]))
        for a, b, (_, lettered) in zip(ahead, back, emit, strict=True):
            total += lettered * (a * b) / (a * b).sum()
        want.append((i // 2, names[int(total.argmax())], round(float(total.max() / total.sum()), 3)))
    got = [(r["doc_id"], r["lang_pred"], round(r["score"], 3)) for r in out.collect()]
    assert sorted((a, b) for a, b, _ in got) == sorted((a, b) for a, b, _ in want)
    assert np.allclose(sorted(x for *_, x in got), sorted(x for *_, x in want), atol=2e-3)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    emit, moves, lengths = rng.random((9, 3)) + 0.1, rng.random((3, 3)) + 0.1, np.array([4, 0, 1, 4])
    got = langid.forward_backward(emit, moves, lengths)[2]
    at = 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.prod([emit[at + i, y] for i, y in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
            for i, y in enumerate(path):
                total[i, y] += p
        if n:
            assert np.allclose(got[at : at + n], total / total.sum(1, keepdims=True))
        at += n


# --- op3 ---------------------------------------------------------------------

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, parents array<string>"
RESULTS = "call_id string, turn long, content string"


def test_toolcalls(spark):
    calls = spark.createDataFrame([
        (1, 0, "a", "search", '{"limit": 2, "query": "q"}', []), (1, 1, "b", "search", '{"limit": 0}', ["a"]),
        (1, 2, "c", "count", '{"items": ["x", 1]}', ["a", "b", "gone"]), (1, 3, "d", "nope", "{}", ["e"]), (1, 4, "e", "count", "[1", ["d"]),
        (2, 0, None, "count", None, []), (2, 1, "f", "summarize", '{"text":"é","style":"odd"}', ["e"])], CALLS)
    results = spark.createDataFrame([("a", 5, "late"), ("a", 1, "early"), (None, 1, "x"), ("zz", 1, "x")], RESULTS)
    out = {r["call_id"]: r for r in toolcalls.format_calls(calls, results).collect()}
    assert [out[k]["level"] for k in "abcdef"] == [0, 1, 2, None, None, None] and out["c"]["missing"] == 1
    assert [out[k]["linked"] for k in ("a", "b", None)] == [True, False, False]
    assert out["a"]["valid"] and out["a"]["message"] == '{"arguments":{"limit":2,"query":"q"},"call_id":"a","level":0,"name":"search","result":"early"}'
    assert out["b"]["errors"] == "$.query: missing; $.limit: below 1" and out["c"]["errors"] == "$.items[1]: not string"
    assert out["d"]["errors"] == "unknown tool" and out["e"]["errors"] == out[None]["errors"] == "$: not JSON"
    assert out["f"]["errors"] == "$.style: not one of the allowed values"
    assert toolcalls.format_calls(calls.limit(0), results.limit(0)).count() == 0


def test_toolcalls_refuse_what_json_cannot_hold(spark):
    bad = ['{"limit": NaN, "query": "q"}', '{"limit": 1e999, "query": "q"}', '{"limit": 1, "query": "\\ud800"}', "[" * 100_000, '{"limit": ' + "9" * 5000 + ', "query": "q"}', None, ""]
    calls = spark.createDataFrame([(1, i, f"c{i}", "search", a, []) for i, a in enumerate(bad)] + [(1, 99, "good", "search", '{"limit": 3, "query": "é"}', ["c0", "c1", "c2"])], CALLS)
    for name in ("of", "result", "level", "missing", "linked", "valid", "errors", "message"):
        calls = calls.withColumn(name, F.lit("x"))
    results = spark.createDataFrame([("good", 1, "r")], RESULTS).withColumn("of", F.lit("x"))
    out = {r["call_id"]: r for r in toolcalls.format_calls(calls, results).collect()}
    assert all(not out[f"c{i}"]["valid"] and out[f"c{i}"]["errors"] == "$: not JSON" and '"arguments":null' in out[f"c{i}"]["message"] for i in range(len(bad)))
    assert out["good"]["valid"] and out["good"]["linked"] and out["good"]["level"] == 1 and json.loads(out["good"]["message"])["result"] == "r"


def test_toolcall_levels_match_brute_force(spark):
    """Long chains, calls with several parents, cycles and what hangs from them."""
    rng = random.Random(5)
    parents = {f"c{i}": ([f"c{i - 1}"] if i % 40 else []) for i in range(120)}
    parents |= {f"d{i}": rng.sample([*parents, *(f"d{j}" for j in range(i))], rng.choice([0, 1, 1, 2, 3])) for i in range(60)}
    parents |= {"x": ["y"], "y": ["z"], "z": ["x"], "tail": ["x"], "self": ["self"], "both": ["tail", "c5"], "gone": ["nowhere", "c7"]}

    def level(call, path=()):
        if call in path:
            return None
        found = [level(p, (*path, call)) for p in parents[call] if p in parents]
        return None if None in found else max(found, default=-1) + 1

    calls = spark.createDataFrame([(k, v) for k, v in parents.items()], "call_id string, parents array<string>")
    out = {r["call_id"]: (r["level"], r["missing"]) for r in toolcalls.order(calls).collect()}
    assert out == {k: (level(k), sum(p not in parents for p in v)) for k, v in parents.items()}


def test_toolcalls_query(spark):
    rows = common.table(spark, SF, "conversations").collect()
    users = {(r["conv_id"], r["turn"]) for r in rows if r["role"] == "user"}
    answers = {(r["conv_id"], r["turn"]): r["text"] for r in rows if r["role"] == "assistant"}
    out = toolcalls.query(spark, SF).collect()
    assert {(r["conv_id"], r["turn"]) for r in out} == users and len(out) == len(users)
    for r in out:
        level, t = 0, r["turn"]
        while (r["conv_id"], t - 2) in users:
            level, t = level + 1, t - 2
        said = json.loads(r["message"])
        assert r["level"] == level and said["result"] == answers.get((r["conv_id"], r["turn"] + 1))
        assert r["message"] == json.dumps(said, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r["valid"] == (not toolcalls.problems(said["arguments"], toolcalls.SCHEMAS[r["name"]]))


def test_toolcall_arguments_hold_the_whole_text(spark):
    texts = {(r["conv_id"], r["turn"]): r["text"] or "" for r in common.table(spark, SF, "conversations").collect() if r["role"] == "user"}
    seen = Counter()
    for r in toolcalls.query(spark, SF).collect():
        said, text = json.loads(r["message"])["arguments"], texts[r["conv_id"], r["turn"]]
        held = {"search": said.get("query"), "summarize": said.get("text"), "count": said.get("items")}[r["name"]]
        assert held == (WORD.findall(text) if r["name"] == "count" else text)
        seen[r["name"]] += len(WORD.findall(text)) > 12
    assert len(seen) == 3 and all(seen.values())


def test_toolcalls_of_system_turns_and_odd_texts(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "be kind"), (1, 1, "user", "\t a  b\nc " + "w " * 61), (1, 2, "assistant", "yes"), (1, 3, "user", None),
        (2, 0, "system", "x"), (2, 2, "user", "p q")], "conv_id long, turn long, role string, text string")
    out = {(r["conv_id"], r["turn"]): r for r in toolcalls.format_calls(*toolcalls.from_conversations(turns)).collect()}
    assert set(out) == {(1, 1), (1, 3), (2, 2)} and [out[k]["missing"] for k in sorted(out)] == [0, 0, 1]
    said = {k: json.loads(r["message"]) for k, r in out.items()}
    assert said[1, 1]["name"] == "search" and said[1, 1]["arguments"]["query"] == "\t a  b\nc " + "w " * 61 and said[1, 1]["result"] == "yes"
    assert said[1, 3]["arguments"] == {"items": []} and said[2, 2]["arguments"] == {"style": "none", "text": "p q"}


# --- op4 ---------------------------------------------------------------------

def check_packing(out, docs, capacity=2048):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for doc_id, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            own = ids[a : a + capacity]
            want[(doc_id, k, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    docs = rows_of(common.table(spark, SF, "documents"), "doc_id", "text")
    out = packing.query(spark, SF).collect()
    used = check_packing(out, docs)
    assert used <= math.ceil(sum(r["length"] for r in out) / 2048) + 2


def test_packed_pieces_hold_the_ids(spark, documents, monkeypatch):
    import corpus_pipeline
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    docs = [(i, t) for i, t in enumerate([None, "", "a b c", "words and more " * 900])]
    table = documents(docs)
    rows = {(r["doc_id"], r["piece"]): r for r in corpus_pipeline.sequences(spark, table, SF).collect()}
    for doc_id, text in docs:
        own = b"".join(bytes(rows[k]["ids"]) for k in sorted(rows) if k[0] == doc_id)
        assert np.frombuffer(own, "<u4").tolist() == [*tok.encode(text or "", add_special_tokens=False).ids, 0]
    made, whole = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a: made.append(whole(*a)) or made[-1])
    digests = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in packing.digest(table).collect()}
    assert len(made) == 1 and "ids" in made[0].columns and digests == {k: zlib.crc32(bytes(r["ids"])) for k, r in rows.items()}


def test_packing_edges(documents):
    texts = [*EDGE_TEXTS, "<|endoftext|> Hi <|ENDOFTEXT|>", "it's I'LL don't.. x.,y ,. .", "é. ß. ﬁ, ́x \x1c y \x85 z", "word " * 5000, "word " * 2047, None]
    docs = list(enumerate(texts)) + [(3, "twice"), (3, "twice"), (None, "nobody")]
    check_packing(packing.digest(documents(docs).repartition(3)).collect(), docs)
    assert packing.digest(documents(docs).limit(0)).count() == 0


def test_words_are_told_apart_without_offsets():
    """Chunks of letters alone take no offsets; every chunk gets the ids that the tokenizer gives it alone."""
    held = packing.Ids(packing.default_tokenizer())
    whole, offsets = held.tokenizer, []

    class Spied:
        def encode_batch(self, texts, **kw):
            offsets.extend(" ".join(texts).split(" "))
            return whole.encode_batch(texts, **kw)

        def encode_batch_fast(self, texts, **kw):
            return whole.encode_batch_fast(texts, **kw)

    held.tokenizer = Spied()
    chunks = [b"of", b"HaAnth.", b"zqxjkv", b"it's", b"12.5", b"a.b.,", b"...", "na\u00efve".encode(), b"don", *(b"w" + b"abcde"[k % 5 : k % 5 + 1] * (k // 5 + 1) for k in range(600))]
    alone = [np.array(whole.encode(c.decode(), add_special_tokens=False).ids, "<u4").tobytes() for c in chunks]
    assert held.ids(chunks) == alone and held.ids(chunks[::-1]) == alone[::-1]
    assert sorted(offsets) == sorted(["it's", "12.5", "a.b", "...", "na\u00efve", ".", ".,"])
    # Where no id ends a word, offsets tell the words apart.
    plain = packing.Ids(packing.default_tokenizer())
    plain.ends_word[:] = False
    assert plain.ids(chunks) == alone
    plain = packing.Ids(packing.default_tokenizer())
    plain.ends_word[:] = True
    assert plain.ids(chunks) == alone


def test_pack_histogram_against_best_fit():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([7, 30, 64])
        counts = {n: rng.randrange(0, 9) for n in range(1, capacity + 1) if rng.random() < 0.6}
        runs = packing.pack_histogram(counts, capacity)
        placed, ranks = {}, Counter()
        for length, a, b, first, offset in runs:
            assert a == ranks[length]
            ranks[length] = b
            for i in range(b - a):
                placed.setdefault(first + i, []).append((offset, length))
        assert ranks == Counter({n: c for n, c in counts.items() if c})
        for spans in placed.values():
            assert sum(n for _, n in spans) <= capacity and sum(3 * n > capacity for _, n in spans) <= 2
            at = 0
            for a, n in sorted(spans):
                assert a == at
                at += n
        bins = []
        for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fit = min((g, i) for i, g in enumerate(bins) if g >= n)[1] if any(g >= n for g in bins) else None
            if fit is None:
                bins.append(capacity - n)
            else:
                bins[fit] -= n
        assert len(placed) <= len(bins) + 1


# --- op5 ---------------------------------------------------------------------

def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and min(len(x), len(y)) * 5 >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
            root[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def test_jaccard_query(spark):
    docs = rows_of(common.table(spark, SF, "documents"), "doc_id", "text")
    assert sorted(rows_of(jaccard.query(spark, SF))) == components(docs)


def test_jaccard_near_copies(documents):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs.append((n, rng.choice([" ", "\n", "  "]).join(own).title()))
            n += 1
    docs += [(n + i, t) for i, t in enumerate([*EDGE_TEXTS, "a b c d", "A  b c\td", "a b c"])]
    assert sorted(rows_of(jaccard.join(documents(docs)))) == components(docs)
    kept = {r["doc_id"] for r in jaccard.keep_first(documents(docs)).collect()}
    assert kept == {i for i, _, least in components(docs) if i == least}


def test_keep_first_decides_by_row(spark):
    far = "q r s t u v w x y z"
    rows = [(1, "a b c d e f", "s1"), (2, "a b c d e f", "s1"), (2, far, "s2"), (None, "m n o p q r", "s"), (None, "m n o p q r", "s"), (None, "k l m n o", "s"),
            (5, None, "s"), (5, None, "s"), (6, "  ", "s"), (7, far, "s3"), (8, "one two", "a"), (8, "one two", "b"), (8, "one two", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("drop_id", "row", "root", "first", "first_id", "text_key", "wordless", "n"):
        docs = docs.withColumn(name, F.lit("x"))
    out = jaccard.keep_first(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    want = [(1, rows[0][1]), (2, far), (None, "m n o p q r"), (None, "k l m n o"), (5, None), (5, None), (6, "  "), (8, "one two")]
    assert got == sorted(want, key=repr)
    assert jaccard.keep_first(docs.limit(0)).count() == 0


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(8)
    for n in (1, 10, 300, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.7], rng.integers(0, 2**63, n // 3).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (jaccard.sketch_of(a).view(np.uint64) ^ jaccard.sketch_of(b).view(np.uint64)))
        assert bits <= len(np.setxor1d(a, b))
    assert not jaccard.sketch_of(np.zeros(0, np.uint64)).any()


def test_jaccard_empty_and_repeated_rows(documents):
    assert jaccard.join(documents([(1, "a")]).limit(0)).count() == 0
    out = rows_of(jaccard.join(documents([(2, "a b c d e f"), (2, "a b c d e f"), (1, None), (5, "A b c d e f")])))
    assert sorted(out) == [(1, 0, 1), (2, 2, 2), (2, 2, 2), (5, 2, 2)]


def test_overlap_bound_is_an_upper_bound():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 2**63, rng.integers(2, 400), dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, len(pool) + 1))) for _ in range(2))
        assert jaccard.overlap_bound(jaccard.bitmap_of(a), len(a), jaccard.bitmap_of(b), len(b)) >= len(np.intersect1d(a, b))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(60) if i != 30], "u string, v string")
    out = dict(rows_of(graph.components(links)))
    assert all(out[f"{i:04d}"] == ("0000" if i <= 30 else "0031") for i in range(61))


# --- op6 ---------------------------------------------------------------------

def test_mixing_targets_and_copies(documents):
    rng = random.Random(4)
    docs = [(i, "w " * rng.randrange(0, 60) if i % 17 else None, "en", rng.choice(["b", "a", None, "é", "c"])) for i in range(800)]
    docs.append((900, None, "en", "zero"))
    df = documents(docs)
    plan = mixing.plan(df).collect()
    size = Counter()
    for _, t, _, s in docs:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    open_, target, rest = set(names), {}, 1.5 * sum(size.values())
    while True:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s], rest = 2.0 * size[s], rest - 2 * size[s]
        open_ -= over
    assert len(plan) == len(docs)
    for r in plan:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == size[r["source"]] and r["copies"] <= 2
    mixed = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    assert mixed == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})
    assert mixing.mix(df).columns == df.columns
    assert mixing.plan(df.limit(0)).count() == 0 and mixing.mix(documents([(1, None)])).count() == 0


# --- op7 ---------------------------------------------------------------------

def tree_score(train, text, depth):
    """Exact batch context-tree weighting with dictionaries of nodes."""
    counts = {}

    def steps(t):
        data = bytes([255]) * depth + t.encode() + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                yield data[i - depth : i][::-1], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    for t in train:
        for context, node, bit in steps(t):
            for d in range(depth + 1):
                counts.setdefault((context[:d], node), [0, 0])[bit] += 1
    kids = {}
    for context, node in counts:
        if context:
            kids.setdefault((context[:-1], node), []).append((context, node))
    memo = {}

    def kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    def weighted(key):
        if key not in memo:
            own = kt(counts[key])
            memo[key] = own if len(key[0]) == depth else np.logaddexp(own, sum(map(weighted, kids.get(key, [])))) - math.log(2)
        return memo[key]

    total = 0.0
    for context, node, bit in steps(text):
        p = None
        for d in range(depth, -1, -1):
            key = (context[:d], node)
            n = counts.get(key, [0, 0])
            own = (n[bit] + 0.5) / (sum(n) + 1)
            w = 1.0 if d == depth else (math.exp(kt(n) - math.log(2) - weighted(key)) if key in counts else 0.5)
            p = own if p is None else w * own + (1 - w) * p
        total += math.log10(p)
    return total


def test_ctw_against_dictionaries(documents):
    texts = ["the cat sat", "the mat", "a cat", "", None, "thé mat the", "zzz", "on the mat the cat", "The CAT  sat\n"]
    docs = list(enumerate(texts))
    out = {r["doc_id"]: r for r in ctw.score(documents(docs).repartition(2), depth=3, bundle_bytes=40).collect()}
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    assert any(held.values())
    train = [fold(t) for i, t in docs if not held[i]]
    c = Counter(w for t in train for w in [*WORD.findall(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in docs:
        tokens = [*WORD.findall(fold(t)), None]
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens))
        assert r["score"] == pytest.approx(tree_score(train, fold(t), 3))


def test_ctw_edges(documents):
    one = documents([(5, "a b"), (5, "a b"), (None, None)])
    out = ctw.score(one, depth=3).collect()
    assert len(out) == 3 and all(math.isfinite(r["score"]) for r in out)
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = ctw.score(documents([(held, "ab")]), depth=3).first()
    assert r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] == pytest.approx(-24 * math.log10(2))
    assert ctw.score(one.limit(0)).count() == 0


def test_ctw_reads_five_bytes_of_context(documents):
    """Only the fifth byte back tells the two endings apart."""
    assert ctw.DEPTH >= 5
    texts = ["pabcdx qabcdy " * 6, "qabcdy pabcdx " * 5, "pabcdx", "pabcdy", "qabcdx"] * 5
    out = {r["doc_id"]: r for r in ctw.score(documents(list(enumerate(texts))).repartition(2), bundle_bytes=100).collect()}
    train = [t for i, t in enumerate(texts) if not out[i]["held_out"]]
    for i, t in enumerate(texts[:5]):
        assert out[i]["score"] == pytest.approx(tree_score(train, t, ctw.DEPTH))


def test_ctw_buckets_follow_both_bytes_and_the_count(documents, monkeypatch):
    """One latest byte spreads over buckets, more grams make more buckets, and scores don't depend on them."""
    pairs = (np.arange(256, dtype=np.uint64) | np.uint64(ord("e") << 8)) << np.uint64(8 * 4)
    older = (np.uint64(ord("e")) | (np.arange(256, dtype=np.uint64) << np.uint64(8))) << np.uint64(8 * 4)
    for codes in (pairs, older):
        found = np.bincount(ctw._bucket(codes, 5, 128), minlength=128)
        assert (found > 0).sum() > 64 and found.max() <= 16
    docs = documents([(i, "the cat sat on the mat " + "abcdefghij"[i:]) for i in range(10)])
    score = lambda: {r["doc_id"]: r["score"] for r in ctw.score(docs).collect()}
    seen, whole = [], ctw.split
    monkeypatch.setattr(ctw, "split", lambda p, d, n: seen.append(n) or whole(p, d, n))
    before = score()
    monkeypatch.setattr(ctw, "BUCKET_GRAMS", 1)
    after = score()
    assert seen[1] > seen[0] == ctw.BUCKETS
    assert after == pytest.approx(before)


def test_ctw_packed_columns():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        code = np.unique(rng.integers(0, 1 << 56, n, np.uint64))
        value = np.log(rng.random(n))
        assert (ctw._unpack_codes(ctw._pack_codes(code)) == code).all() and (ctw._unpack(ctw._pack(value), np.float64) == value).all()


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.9, 8, 100.5, 1e6 + 0.5])
    assert np.allclose(ctw._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


# --- op8 ---------------------------------------------------------------------

def base_stats(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics(documents):
    rng = random.Random(9)
    texts = [*EDGE_TEXTS, "a b c d e " * 20, "l1 x\nl1 x\n \nl2\nl1 x", "#*$ %&|<>^"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    out = {r["doc_id"]: r for r in quality.assess(documents(list(enumerate(texts))), quality.DecisionList(())).collect()}
    for i, t in enumerate(texts):
        s = base_stats(t)
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == s, t
        assert r["base_failed"] == (s[0] < 10 or 100 * s[4] > 20 * s[0]) and r["kept"] == (not r["base_failed"])


def test_quality_learns_threshold_rules(spark, documents):
    rng = random.Random(2)
    good = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(12, 60)))) for i in range(150)]
    bad = [(1000 + i, " | ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(12, 60)))) for i in range(50)]
    docs = documents(good + bad)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad[:30]] + [(None, 1), (77777, 0), (3, None)], "doc_id long, quality int")
    rules = quality.fit(docs, labels)
    assert rules.rules
    kept = {r["doc_id"] for r in quality.keep_good(docs, rules).collect()}
    assert {i for i, _ in good} <= kept and len(kept - {i for i, _ in good}) <= 3
    assert quality.keep_good(docs, rules).columns == docs.columns
    assert quality.fit(docs, labels.limit(0)).rules == () and quality.assess(docs.limit(0), rules).count() == 0


def test_quality_query(spark):
    out = {r["doc_id"]: r for r in quality.query(spark, SF).collect()}
    for r in common.table(spark, SF, "documents").collect():
        got = out[r["doc_id"]]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == base_stats(r["text"])
        assert not (got["base_failed"] and got["kept"])
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, SF, "labels").collect()}
    good = [out[i]["kept"] for i, q in labels.items() if q == 1]
    assert sum(good) >= 0.95 * len(good)


# --- op9 ---------------------------------------------------------------------

def test_warc_round_trip(spark, scratch):
    big, rng = "<p>" + "x" * 120 + "</p>", random.Random(1)
    rows = [(7, "u\r\nv", big), (3, "u3", big), (9, None, big), (3, "u3", big), (None, "n", big), (4, "s", "tiny"), (5, "s", "tiny"), (6, "e", None), (8, "é", "é" * 60)]
    rows += [(100 + i, f"u{i}", "".join(rng.choice("abc<>") for _ in range(rng.randrange(0, 900)))) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    warc.write(pages, scratch + "/a", archive_bytes=20_000).collect()
    out = warc.read(spark, scratch + "/a").collect()
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if (h or "").encode() == data and p is not None), default=None) if len(data) >= 100 else None
        same = sum((h or "").encode() == data for _, _, h in rows)
        again = first is not None and same > 1 and first != page
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r)[:5] for r in out], key=key) == sorted(want, key=key)
    for r in out:
        assert r["record_type"] == "revisit" or hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
    warc.write(pages.limit(0), scratch + "/none").collect()


def test_warc_archive_layout():
    import struct

    import zstandard

    records = [warc.record(i, "u", b"payload %d " % i * 30, "d" * 64, None) for i in range(50)]
    data = warc.pack_archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.SKIPPABLE
    known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    assert one.decompress(data[8 + size :]) == records[0] and one.unused_data  # a record is a frame
    assert [b for _, b in warc.unpack_archive(data)] == [warc.HTTP_HEAD + b"payload %d " % i * 30 for i in range(50)]


# --- op10 --------------------------------------------------------------------

def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(700, 5)), 1)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(800, None), (801, [1.0, None, 0.0, 0.0, 0.0]), (900, [float("nan")] * 5), (1000, [float("inf")] * 5), (None, [1.0] * 5), (1100, []), (1200, [1.0, 2.0])]
    rows += [(i, [float(x) for x in points[0]]) for i in range(1300, 1330)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = rows_of(topk.search(df, block_rows=150))
    real = [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in rows if i is not None and v and len(v) == 5 and None not in v and np.isfinite(v).all()]
    want = []
    for i, q in real:
        if i % 100 == 0:
            best = sorted((-int(q @ v), j) for j, v in real if j != i)[:10]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(got) == sorted(want)
    assert topk.search(df.limit(0)).count() == 0


def test_topk_of_large_components_and_repeated_queries(spark):
    rows = [(100, [2.0, 0.0]), (100, [1.0, 0.0]), (1, [3.0, 1.0]), (2, [-1.0, 5.0]), (3, [1e300, 0.0]), (4, [1e6, 0.0]), (5, [1e10, 0.0]), (1, [3.0, 1.0])]
    got = rows_of(topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    k = 1024 * 1024
    assert got == [(100, 1, 4, 1_000_000 * k), (100, 2, 1, 3 * k), (100, 3, 1, 3 * k), (100, 4, 2, -k)] and topk.limit(2) > 1024 * 1e6


def test_mtree_skips_by_bounds():
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 8)) * 50
    points = np.concatenate([c + rng.normal(size=(300, 8)) for c in centers])
    tree, seen = topk.MTree(points), []
    q = points[5]

    def evaluate(rows):
        seen.extend(rows.tolist())
        return np.sort(((points[seen] - q) ** 2).sum(1) ** 0.5)[9] if len(seen) >= 10 else np.inf

    tree.search(q, evaluate, 1e-9)
    best = set(np.argsort(((points - q) ** 2).sum(1))[:10].tolist())
    assert best <= set(seen) and len(seen) < len(points) / 3


def test_text_slices_are_whole_and_readable():
    import pyarrow.compute as pc

    texts = [None, "É" * 50, "", "Ab…c " * 40, None, "ß x" * 100, "Z"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(common.text_slices(batch.slice(1), 500))
    assert len(parts) > 5 and [x for p in parts for x in p["doc_id"].to_pylist()] == list(range(1, len(texts)))
    folded = [x for p in parts for x in pc.ascii_lower(p["text"].cast(pa.large_string()).fill_null("")).to_pylist()]
    assert folded == [(t or "").encode().lower().decode() for t in texts[1:]]
