"""Quality rules: base text statistics plus a learned decision list.

Method: sequential covering.  A bounded sample of labelled rows gives counts
of good and bad documents per cell of binned statistics (one Spark
aggregation).  From these counts rules are grown one after the other: each is
a short conjunction of thresholds, grown on two thirds of the labels by
information gain, pruned on the last third, accepted only when it is precise
there, and its rows are removed before the next one is grown.  The list is
emitted as one ordered ``CASE WHEN`` expression, so scoring is a narrow
projection in the JVM over all documents.

Defined results: a null text counts as empty (0 words, base_failed true);
labels that are null, or whose document is missing, teach nothing; without
bad labels the list is empty and only the base rule rejects; repeated rows are
scored row by row; all other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, let, table, words

WINDOW = 5
SYMBOLS = r"[^#*$%&|<>]+"
HAS_WORD = r"[^\x20\x09-\x0D]"

#: Statistics that rules may test, as (name, expression over the struct m).
FEATURES = ("n_words", "mean_chars", "symbol_share", "upper_share", "dup_line_share", "repeat_share",
            "distinct_share", "mark_share")


def _repeat_words(w: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in ``w``.

    Windows are compared by a 64-bit hash.  Sorting (hash, position) puts
    equal windows side by side; the covered words are the union of the
    intervals [p, p + 4].
    """
    keys = F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]),
    )

    def covered(k: Column) -> Column:
        pairs = F.array_sort(F.transform(k, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))

        def positions(s: Column) -> Column:
            at = F.filter(
                s,
                lambda x, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == x["h"]))
                | ((j < F.size(s) - 1) & (s[F.least(j + 1, F.size(s) - 1)]["h"] == x["h"])),
            )
            return F.array_sort(F.transform(at, lambda x: x["p"]))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        union = F.aggregate(
            let(pairs, positions),
            start,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )
        return F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(union)

    return F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(let(keys, covered))


def measure(text: Column) -> Column:
    """Struct of the base statistics and of those that rules test, for one text."""
    t = F.coalesce(text, F.lit(""))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
    ))
    of_lines = let(F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD)), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    return F.struct(
        of_words.alias("w"), of_lines.alias("l"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(t, "[^!?;:]+", "")).cast("long").alias("n_marks"),
    )


def flatten(m: Column) -> list[Column]:
    """Columns of a measured struct: base statistics, then the tested features."""
    n, chars = m["w"]["n_words"], m["w"]["word_chars"]
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return [
        n.alias("n_words"), chars.alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
        per(chars, n).alias("mean_chars"), per(m["n_symbols"], n).alias("symbol_share"),
        per(m["n_upper"], chars).alias("upper_share"), per(m["l"]["n_dup_lines"], m["l"]["n_lines"]).alias("dup_line_share"),
        per(m["w"]["n_repeat_words"], n).alias("repeat_share"), per(m["w"]["n_distinct"], n).alias("distinct_share"),
        per(m["n_marks"], n).alias("mark_share"),
    ]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects, and none holding keeps."""

    rules: tuple[tuple[Condition, ...], ...]

    def keeps(self) -> Column:
        chosen = F.when(F.lit(False), F.lit(False))
        for rule in self.rules:
            holds = rule[0].column()
            for c in rule[1:]:
                holds = holds & c.column()
            chosen = chosen.when(holds, F.lit(False))
        return chosen.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, bins: int = 16, max_rules: int = 12,
    max_conditions: int = 3, min_precision: float = 0.95, min_support: int = 3,
) -> DecisionList:
    """Learn a decision list from at most ``max_labelled`` labelled rows.

    The sample (lowest hashes of doc_id) bounds both the broadcast side of
    the join and the counts that reach the driver.  Every other statistic of
    this operator covers all rows.
    """
    sample = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("good"))
        .where("label_id is not null and good is not null")
        .groupBy("label_id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    stats = rows.select("label_id", "good", measure(F.col("text")).alias("m")).select(
        "label_id", (F.col("good") > 0).cast("int").alias("good"), *flatten(F.col("m")))
    stats = cut(stats.select((F.xxhash64(F.lit("prune"), "label_id") % 3 == 0).alias("prune"), "good",
                         *[F.col(f).cast("double").alias(f) for f in FEATURES],
                         base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("failed")))
    # After the cut: before it, this filter would be pushed below the join and measure every document.
    stats = stats.where("not failed")
    share = [i / bins for i in range(1, bins)] + [0.005, 0.01, 0.02, 0.98, 0.99, 0.995]
    per_class = lambda f, good: F.percentile_approx(F.when(F.col("good") == good, F.col(f)), share, 2000)
    cuts = stats.agg(*[per_class(f, g).alias(f"{f}_{g}") for f in FEATURES for g in (0, 1)]).first()
    edges = {f: _between({x for g in (0, 1) for x in (cuts[f"{f}_{g}"] or [])}) for f in FEATURES}
    cell = [F.lit(0) if not edges[f] else _cell(F.col(f), edges[f]) for f in FEATURES]
    counts = stats.groupBy("prune", "good", *[c.alias(f) for c, f in zip(cell, FEATURES, strict=True)]).count().collect()
    if not counts:
        return DecisionList(())
    cells = np.array([[r[f] for f in FEATURES] for r in counts], dtype=np.int16)
    n = np.array([r["count"] for r in counts], dtype=np.int64)
    bad = np.array([r["good"] == 0 for r in counts])
    prune = np.array([r["prune"] for r in counts])
    return DecisionList(tuple(_cover(cells, n, bad, prune, edges, max_rules, max_conditions, min_precision, min_support)))


def _between(values: set[float]) -> list[float]:
    """Midpoints of neighbouring quantiles: a rule keeps its distance from both sides."""
    ordered = sorted(values)
    return [(a + b) / 2 for a, b in zip(ordered, ordered[1:], strict=False)]


def _cell(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges below ``value``."""
    return F.aggregate(F.array(*[F.lit(float(x)) for x in edges]), F.lit(0),
                       lambda a, e: a + F.when(value > e, 1).otherwise(0))


def _cover(cells, n, bad, prune, edges, max_rules, max_conditions, min_precision, min_support):
    """Sequential covering over cell counts; yields rules in order."""
    tests = [(j, above, k) for j, f in enumerate(FEATURES) for k in range(len(edges[f])) for above in (True, False)]
    masks = np.array([(cells[:, j] > k) if above else (cells[:, j] <= k) for j, above, k in tests])
    if not len(tests):
        return
    left = np.ones(len(n), bool)
    for _ in range(max_rules):
        use, rule = left & ~prune, []
        while len(rule) < max_conditions:
            p0, n0 = n[use & bad].sum(), n[use & ~bad].sum()
            if p0 < min_support or (rule and n0 == 0):
                break
            p = masks[:, use & bad] @ n[use & bad]
            q = masks[:, use & ~bad] @ n[use & ~bad]
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + q, 1)) - math.log2(p0 / (p0 + n0))), -1.0)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9:
                break
            rule.append(best)
            use = use & masks[best]
        rule = _prune(rule, masks, n, bad, left & prune)
        if not rule:
            return
        holds = masks[rule].all(axis=0) & left
        good, wrong = n[holds & bad].sum(), n[holds & ~bad].sum()
        if good < min_support or good < min_precision * (good + wrong):
            return
        left &= ~holds
        yield tuple(Condition(FEATURES[tests[t][0]], tests[t][1], float(edges[FEATURES[tests[t][0]]][tests[t][2]])) for t in rule)


def _prune(rule, masks, n, bad, held):
    """Drop final conditions while (p - q) / (p + q) on the held-out rows does not fall."""
    def worth(r):
        m = masks[r].all(axis=0) & held
        p, q = n[m & bad].sum(), n[m & ~bad].sum()
        return (p - q) / (p + q) if p + q else -1.0

    if not rule or not n[held & bad].sum():
        return rule
    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def assess(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, base statistics, base_failed and kept for every document."""
    m = docs.select("doc_id", measure(F.col("text")).alias("m"))
    s = m.select("doc_id", *flatten(F.col("m")))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return s.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & rules.keeps()).alias("kept"))


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    m = docs.select(F.struct("*").alias("row"), measure(F.col("text")).alias("m"))
    s = m.select("row", *flatten(F.col("m")))
    return s.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")) & rules.keeps()).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return assess(docs, fit(docs, table(spark, sf_dir, "labels")))
