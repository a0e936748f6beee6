"""Personal data: regular expressions propose spans, validators and context decide.

Method: per kind, a pattern proposes leftmost non-overlapping spans, a
checksum or range check confirms them (Luhn for cards, mod-97 for IBANs, byte
range for addresses, digit counts for phones), and words near a span move its
score.  Kinds without a checksum of their own (national ids, phones without a
country code) start below the threshold and need such a word.

Patterns are written so that matching is linear and does not recurse per
character: runs are possessive and start where a run starts.  Each accepts the
same spans as the plain form in its comment.  Positions come from splitting
the text by the same pattern: a span starts after all pieces and spans before
it.  Everything is a DataFrame expression over one row, so the plan is one
narrow projection: no shuffle, and a hot source or a group of copies costs no
more than its rows.

Defined results: a null text counts as empty (no spans); positions are code
points with exclusive ends; repeated rows are treated row by row; other
columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Matches that are summed up together, and characters of a block of text.
BLOCK, TEXT_BLOCK = 256, 1024
SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


@dataclass(frozen=True)
class Kind:
    """needs: a cheap pattern without which no span exists.  valid: the check
    of a matched string.  score: without context; near: words that add ``bonus``
    when they stand within ``reach`` characters before or after."""

    name: str
    pattern: str
    needs: str
    valid: object
    score: float
    near: str = ""
    bonus: float = 0.3
    reach: int = 40
    least: int = 4  # characters that a match has at least


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _mod97(m: Column) -> Column:
    """ISO 13616: country and check digits go last, letters become 10 to 35, the rest mod 97 is 1."""
    compact = F.regexp_replace(m, " ", "")
    moved = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        value = F.ascii(ch) - F.when(ch.rlike("[A-Z]"), 55).otherwise(48)
        return F.when(value > 9, (acc * 100 + value) % 97).otherwise((acc * 10 + value) % 97)

    return F.length(compact).between(15, 34) & (F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), step) == 1)


#: Email: local+ @ label (. label)+.  After a span that ends inside a run of
#: local characters the rest of the run may start the next one (\G).  The
#: second label and those after it run up to ".." or a final dot.
EMAIL = Kind(
    "email",
    rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++\.{_LABEL}[A-Za-z0-9.-]*?(?=\.\.|\.?+(?![A-Za-z0-9.-]))",
    "@", None, 0.95)
#: Address: number (. number) three times; numbers are whole runs of digits.
IP = Kind(
    "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
    lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), 0.9)
#: Card: digits with at most one blank or hyphen between them; of all such
#: maximal runs only those of 16 to 19 digits can pass.
CARD = Kind(
    "card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])", "[0-9]",
    lambda m: F.call_function("luhn_check", _digits(m)), 0.9,
    r"\b(?:card|visa|credit|debit|payment|karte|carte|tarjeta)\b", 0.1)
PHONE = Kind(
    "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.85,
    r"\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b", 0.1)
IBAN = Kind(
    "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "[A-Z]{2}[0-9]{2}", _mod97, 0.95, r"\biban\b", 0.05)
NATIONAL_ID = Kind(
    "national_id", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-",
    None, 0.4, r"\b(?:ssn|social security|national id|tax id)\b", 0.5)
LOCAL_PHONE = Kind(
    "local_phone", r"(?<![0-9+()-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])", "[0-9]{3}[.-][0-9]{4}",
    None, 0.4, r"\b(?:phone|tel|call|fax|mobile)\b", 0.4)

BASE = (EMAIL, IP, CARD, PHONE)
MORE = (IBAN, NATIONAL_ID, LOCAL_PHONE)
THRESHOLD = 0.6


def _none() -> Column:
    return F.from_json(F.lit("[]"), SPAN)


def _running(values: Column, join, start: Column) -> Column:
    """Running totals of an array under ``join``, block by block: no array is copied once per element of the whole."""
    last = lambda totals: F.element_at(totals, -1)
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    inner = F.transform(blocks, lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), F.array(start), lambda acc, x: F.concat(acc, F.array(join(last(acc), x)))))

    def shifted(totals: Column) -> Column:
        before = F.aggregate(totals, F.array(start), lambda acc, own: F.concat(acc, F.array(join(last(acc), last(own)))))
        return F.flatten(F.zip_with(totals, F.slice(before, F.lit(1), F.size(totals)), lambda own, at: F.transform(F.slice(own, F.lit(2), F.size(own)), lambda x: join(at, x))))

    return let(inner, shifted)


def _spans(text: Column, kind: Kind) -> Column:
    """Spans of one kind in ``text`` (a bound variable), scored and checked.

    Positions are running sums over the pieces between the matches, and the
    context of a match is put together from its neighbours, so the work grows
    with the text, not with its length times its spans.
    """
    # A match is ``least`` characters long, so so many of them fill the reach.
    near = -(-kind.reach // kind.least)

    def placed(m: Column) -> Column:
        def over(pieces: Column) -> Column:
            lengths = F.transform(m, lambda x, i: (F.length(F.get(pieces, i)) + F.length(x)).cast("long"))
            return let(F.transform(pieces, lambda p: F.struct(F.left(p, F.lit(kind.reach)).alias("head"), F.right(p, F.lit(kind.reach)).alias("tail"))) if kind.near else pieces,
                       lambda ends_of: let(_running(lengths, lambda a, x: a + x, F.lit(0).cast("long")), lambda ends: F.filter(F.transform(m, lambda x, i: span(x, i, F.get(ends, i), ends_of)), lambda x: x.isNotNull())))

        def span(x: Column, i: Column, end: Column, sides: Column) -> Column:
            score = F.lit(kind.score)
            if kind.near:
                first, n = F.greatest(i - near, F.lit(0)), F.least(i, F.lit(near))
                before = F.zip_with(F.slice(sides, first + 1, n), F.slice(m, first + 1, n), lambda p, y: F.concat(p["tail"], y))
                behind = F.zip_with(F.slice(m, i + 2, F.lit(near)), F.slice(sides, i + 3, F.lit(near)), lambda y, p: F.concat(y, F.coalesce(p["head"], F.lit(""))))
                left = F.right(F.concat(F.array_join(before, ""), F.get(sides, i)["tail"]), F.lit(kind.reach))
                right = F.left(F.concat(F.get(sides, i + 1)["head"], F.array_join(behind, "")), F.lit(kind.reach))
                score = score + F.when(F.lower(F.concat_ws(" ", left, right)).rlike(kind.near), F.lit(kind.bonus)).otherwise(F.lit(0.0))
            ok = F.lit(True) if kind.valid is None else F.coalesce(kind.valid(x), F.lit(False))
            made = F.struct(F.lit(kind.name).alias("kind"), (end - F.length(x)).cast("long").alias("start"), end.alias("end"), score.alias("score"))
            return F.when(ok & (made["score"] >= THRESHOLD), made)

        return F.when(F.size(m) == 0, _none()).otherwise(let(F.split(text, kind.pattern, -1), over))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), placed)
    return F.when(text.rlike(kind.needs), found).otherwise(_none())


def spans_of(text: Column) -> Column:
    """Struct (base, more): base spans by kind and start, then those the method adds.

    An added span that touches a base span is dropped, so that no text is
    counted twice; base spans always stay.
    """

    def both(t: Column) -> Column:
        base = F.concat(*[_spans(t, k) for k in BASE])
        more = F.concat(*[_spans(t, k) for k in MORE])
        clear = let(base, lambda b: F.struct(b.alias("base"), F.filter(more, lambda x: ~F.exists(
            b, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))).alias("more")))
        return clear

    return let(F.coalesce(text, F.lit("")), both)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of the base kinds) and more (added spans) per document."""
    return docs.select("doc_id", spans_of(F.col("text")).alias("found")).select("doc_id", "found.base", "found.more")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by [KIND]; n_chars follows the text.

    Of overlapping spans of different kinds the one that starts first (the
    longer one on a tie) is named, and the replaced range is their union.
    """

    def masked(t: Column) -> Column:
        # The text in blocks, so that what lies between two spans is found without counting from its start.
        cut = lambda x, size: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(x) - 1, F.lit(0)) / size).cast("int")),
                                          lambda i: F.substring(x, i * size + 1, F.lit(size)))
        blocks = F.flatten(F.transform(cut(t, TEXT_BLOCK * 64), lambda part: cut(part, TEXT_BLOCK)))

        def between(parts: Column, a: Column, b: Column) -> Column:
            first = F.floor(a / TEXT_BLOCK).cast("int")
            some = F.array_join(F.slice(parts, first + 1, F.floor(b / TEXT_BLOCK).cast("int") - first + 1), "")
            return F.substring(some, (a - first * TEXT_BLOCK).cast("int") + 1, (b - a).cast("int"))

        def write(parts: Column, s: Column, ends: Column) -> Column:
            def piece(x: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))
                mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
                return F.when(x["start"] < before, F.lit("")).otherwise(F.concat(between(parts, before, x["start"]), mark))

            return F.concat(F.array_join(F.transform(s, piece), ""), between(parts, F.element_at(ends, -1), F.length(t).cast("long")))

        def named(s: Column) -> Column:
            ends = _running(F.transform(s, lambda x: x["end"]), F.greatest, F.lit(0).cast("long"))
            return F.when(F.size(s) == 0, t).otherwise(let(blocks, lambda parts: let(ends, lambda e: write(parts, s, e))))

        ordered = let(spans_of(t), lambda f: F.transform(
            F.array_sort(F.transform(F.concat(f["base"], f["more"]), lambda x: F.struct(
                x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind")))),
            lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["kind"].alias("kind"))))
        return let(ordered, named)

    text = F.when(F.col("text").isNotNull(), let(F.col("text"), masked))
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k.name).alias(f"n_{k.name}") for k in BASE],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "more")).alias("spans"))
