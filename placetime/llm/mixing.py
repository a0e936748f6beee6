"""Mixing sources to target weights by repetition rates.

Method: words are summed per source, each source gets a target from its
weight, the target over the source's size is its repetition rate, and each
document is emitted floor(rate) times plus once more when a draw from the hash
of its id falls below the fraction.  Draws depend on the seed and the id
alone, so reruns and other partitionings agree.

The totals are one aggregation with map-side combine; a hot source is one row
after it.  The table of sources is small against the documents but not
assumed tiny: its ranks come from range partitions and per-partition counts.  It
is measured and broadcast below a bound of bytes, so documents are not shuffled;
beyond it the join is a shuffle join.

Defined results: a null text has size 0; a null source is a source of its
own, last in the order; a source of size 0 has target 0 and rate 0; rows with
the same id get the same draw; null ids share one draw; other columns are kept
by ``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, cut, stored, table

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_RATE = 2
SEED = "mix"
#: The table of sources is broadcast up to this size.
BROADCAST_BYTES = 8 << 20


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from the first 32 bits of an MD5 of seed and id."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def _ranked(sources: DataFrame) -> DataFrame:
    """Add the 0-based position of each source by code point, null last.

    UTF-8 bytes sort as code points.  Range partitions are sorted on their
    own and offset by the counts of those before them, one row a partition.
    """
    spread = sources.repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(
        F.col("source").isNull(), "source").select("*", F.monotonically_increasing_id().alias("at"))
    spread = spread.select("*", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"))
    spread = cut(spread)
    sizes = {r["part"]: r["count"] for r in spread.groupBy("part").count().collect()}
    base, before = {}, 0
    for part in sorted(sizes):
        base[part], before = before, before + sizes[part]
    if not base:
        return spread.select("source", "source_size", F.lit(0).cast("long").alias("pos"))
    offset = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    return spread.select("source", "source_size", (offset[F.col("part")] + F.col("nth")).alias("pos"))


def targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """source, source_size, target from a table (source, size).

    Level filling: with L words per unit of weight, a source takes
    min(L * weight, max_rate * size).  L starts as if no source were full;
    each round takes the full ones out and shares the rest again, until no
    new one is above.  A round is one aggregation over the sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(per_source)
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.select("source", "source_size", pick.cast("long").alias("weight")))
    cap = (F.col("source_size") * max_rate).cast("double")
    total = ranked.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = 0.0
    if total:
        level, full = None, -1
        while True:
            is_full = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
            row = ranked.agg(F.sum(F.when(is_full, F.col("source_size") * max_rate)).alias("taken"),
                             F.sum(F.when(~is_full, F.col("weight"))).alias("weight"),
                             F.sum(is_full.cast("int")).alias("full")).first()
            if row["full"] == full or not row["weight"]:
                break
            full, level = row["full"], (total_share * total - (row["taken"] or 0)) / row["weight"]
    return ranked.select("source", "source_size", F.least(F.lit(float(level)) * F.col("weight"), cap).alias("target"))


def _bounded(t: DataFrame) -> DataFrame:
    """The table of sources, to be broadcast while its names are within ``BROADCAST_BYTES``."""
    size = t.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("of"), F.lit(0)) + 32), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(t) if size <= BROADCAST_BYTES else t


def plan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every document."""
    spark = docs.sparkSession
    sizes = stored(spark, docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    t = targets(sizes, **options).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sizes.join(_bounded(t), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.select("doc_id", "source", "size", "source_size", "target", copies(rate, F.col("doc_id")).alias("copies"))


def copies(rate: Column, doc_id: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(doc_id) < rate - whole).cast("int")).cast("long")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it."""
    t = targets(docs.select("source", size_of(F.col("text")).alias("size")), **options)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = _bounded(t.select(F.col("source").alias("of"), rate.alias("rate")))
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(rates, F.col("row.source").eqNullSafe(F.col("of")), "left")
    n = copies(F.col("rate"), F.col("row.doc_id"))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("nth")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = plan(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, CAST(encode(source) AS BLOB)) - 1) % 3] AS weight FROM per),
levels AS (
  SELECT 1 AS step, 1.5::DOUBLE * sum(source_size) / sum(weight) AS lvl FROM weighed
  UNION ALL
  SELECT any_value(l.step) + 1,
         (1.5::DOUBLE * sum(source_size) - coalesce(sum(2 * source_size) FILTER (WHERE l.lvl * weight > 2 * source_size), 0))
         / sum(weight) FILTER (WHERE NOT l.lvl * weight > 2 * source_size)
  FROM levels l, weighed WHERE l.step < 40 GROUP BY l.lvl, l.step),
final AS (SELECT max_by(lvl, step) AS lvl FROM levels WHERE lvl IS NOT NULL),
targets AS (SELECT w.source, w.source_size, least(lvl * weight, CAST(2 * source_size AS DOUBLE)) AS target FROM weighed w, final)
SELECT s.doc_id, s.size, t.source_size, t.target,
  CAST(s.size * CASE WHEN t.source_size = 0 THEN 0 ELSE
    floor(target / t.source_size) + CASE WHEN
      CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
      < target / t.source_size - floor(target / t.source_size) THEN 1 ELSE 0 END END AS BIGINT) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
"""
