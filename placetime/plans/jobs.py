"""Composite jobs: the batch preprocessing job, the analysis report, and
sink round-trips, registered next to the single-operator queries.

Jobs write their tables under a given folder (or the shared checkpoint
folder for the registered versions); they never collect row data.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import clean, correlation, filters, ml, pivot, replicate, sketch, spatial
from ..functions.hashing import keyed_int
from ..roles import LAT_LOW, LAT_WIDTH, LON_LOW, LON_WIDTH, MISSING_CATEGORY, NA_TOKENS, ColumnRoles, FilterSpec
from ..session import scratch_path
from ..sources import files
from ..sources import fixtures as fxt
from ..sources.schema import place_column, require_columns
from ..sources.shared import shared_table
from . import oracle as o
from .registry import RAW_ROLES, ROLES, W, register

EXPORT_SCHEMA = "key long, category string, lat double, lon double, hour int"


# ---------------------------------------------------------------------------
# K2: preprocessing job
# ---------------------------------------------------------------------------
@dataclass
class PrepareResult:
    rows: DataFrame  # the exported table, read back
    top: DataFrame  # category counts, most frequent first
    predictions: DataFrame | None  # test rows scored by the batch forest
    location_column: str | None


def prepare(df: DataFrame, roles: ColumnRoles, out_path: str, term: str, copies: int = 3,
            train: bool = True, location_keywords=None) -> PrepareResult:
    """scan -> drop nulls -> place filter -> replicate -> simulate place/time
    -> top categories -> train -> export.

    The place column is found by name; without one, the first string column
    holding the term is used (one probe job), and without a match all rows
    are kept.  Replication is one ``explode``; the simulated coordinates
    and hour are keyed by (key, copy).
    """
    require_columns(df, [roles.category, roles.key])
    data = clean.drop_any_null(df)
    loc = place_column(data.columns, location_keywords) if location_keywords else place_column(
        data.columns)
    if loc:
        picked = filters.place_filter(data, loc, term)
    else:
        picked, loc = filters.first_string_match(data, term)
    rep = replicate.replicate(picked.select(roles.key, roles.category), copies)
    sim = replicate.simulate_place_time(rep, roles)
    export = sim.select(roles.key, "copy", roles.category, roles.lat, roles.lon, roles.hour)
    files.write_table(export, out_path, "parquet")
    rows = export.sparkSession.read.parquet(out_path)
    top = agg.ranked_counts(rows, roles.category)
    preds = None
    if train:
        keyed = rows.withColumn("_rk", F.concat_ws("|", F.col(roles.key).cast("string"), F.col("copy").cast("string")))
        res = ml.train_classifier(keyed, roles.category, "_rk", "batch",
                                  numeric=(roles.lat, roles.lon, roles.hour), categorical=())
        preds = res.predictions
    return PrepareResult(rows, top, preds, loc)


_copy_key = "(CAST(key AS VARCHAR) || '|' || CAST(copy AS VARCHAR))"


@register("prepare_job", W(o.INCIDENTS_PLACE) + f"""
SELECT key, copy, category, {o.krange('lat', LAT_LOW, LAT_WIDTH, 'key', 'copy')} AS lat,
       {o.krange('lon', LON_LOW, LON_WIDTH, 'key', 'copy')} AS lon, {o.kint('hour', 24, 'key', 'copy')} AS hour,
       {o.u('split42', _copy_key)} < 0.2::DOUBLE AS scored
FROM (SELECT key, category, CAST(c.range AS INTEGER) AS copy FROM incidents_place, range(1, 4) c
      WHERE strpos(region, 'AMERICA') > 0)""")
def q_prepare_job(spark, d):
    """The exported rows, and whether the trained forest scored each with one of its classes."""
    src = fxt.incidents_place(spark, d).select("key", "category", "region", "nation")
    out = scratch_path(spark, f"prepare-{uuid.uuid4().hex}")
    res = prepare(src, ROLES, out, term="AMERICA")
    scored = res.predictions.where(F.col("prediction").isNotNull()).select(F.col("_rk"), F.lit(True).alias("scored"))
    rows = res.rows.withColumn("_rk", F.concat_ws("|", F.col("key").cast("string"), F.col("copy").cast("string")))
    return rows.join(scored, "_rk", "left").drop("_rk").na.fill({"scored": False})


@register("prepare_top", W(o.INCIDENTS_PLACE) + """
SELECT category, 3 * count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS pos FROM incidents_place
WHERE strpos(region, 'AMERICA') > 0 GROUP BY category""")
def q_prepare_top(spark, d):
    """The job's table of categories, most frequent first."""
    src = fxt.incidents_place(spark, d).select("key", "category", "region", "nation")
    return prepare(src, ROLES, scratch_path(spark, f"prepare-{uuid.uuid4().hex}"), term="AMERICA", train=False).top


# ---------------------------------------------------------------------------
# K1: analysis report
# ---------------------------------------------------------------------------
def build_report(df: DataFrame, roles: ColumnRoles, out_dir: str, seed: int = 42, restarts: int = 10,
                 preset: str = "dashboard", train: bool = True) -> dict[str, str]:
    """clean -> cluster -> train -> correlation, hourly counts, summary,
    heatmap; one table per output under ``out_dir``.

    The enriched frame is persisted before anything reads it, so the input is
    read once, and released at the end, whatever happens.
    """
    base = clean.prepare_base(df, roles).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_report(base, roles, out_dir, seed, restarts, preset, train)
    finally:
        base.unpersist(blocking=True)


def _write_report(base: DataFrame, roles: ColumnRoles, out_dir: str, seed: int, restarts: int, preset: str, train: bool) -> dict[str, str]:
    clustered, fit = spatial.attach_clusters(base, roles, seed=seed, restarts=restarts)
    spark = base.sparkSession
    outputs: dict[str, DataFrame] = {}
    paths: dict[str, str] = {}
    feats = correlation.correlation_frame(clustered, roles.hour, roles.lat, roles.lon, "day", "time_band",
                                          "cluster_id")
    outputs["correlation"] = correlation.corr_matrix(feats)
    hourly = agg.hourly_trend(clustered, roles.hour)
    outputs["hourly"] = hourly
    outputs["summary"] = agg.summary_stats(clustered, roles.category, roles.hour)
    outputs["heatmap"] = pivot.heatmap_normalized(clustered, roles.category, roles.hour)
    outputs["centers"] = spatial.centers_frame(spark, fit)
    outputs["clusters"] = spatial.cluster_summary(clustered, "cluster_id", roles.lat, roles.lon)
    if train:
        res = ml.train_classifier(clustered, roles.category, roles.key, preset, seed=seed)
        outputs["model_status"] = ml.status_frame(spark, res)
        if res.prior is not None:
            outputs["prior"] = res.prior
        if res.ready:
            from ..operators import metrics

            outputs["predictions"] = scored = res.predictions  # already written rows
            outputs["confusion"] = metrics.confusion_matrix(scored, classes=res.classes)
            outputs["report"] = metrics.classification_report(scored)
            outputs["importance"] = ml.feature_importance(spark, res)
    for name, table in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        files.write_table(table, path, "parquet")
        paths[name] = path
    return paths


REPORT_SQL = W(o.INCIDENTS, o.HOURS) + """
, c AS (SELECT hour, count(*) AS n FROM incidents GROUP BY hour)
, h AS (SELECT hours.hour, coalesce(c.n, 0) AS n FROM hours LEFT JOIN c USING (hour))
SELECT 'hourly' AS part, CAST(hour AS VARCHAR) AS item, CAST(n AS DOUBLE) AS value FROM h
UNION ALL SELECT 'heatmap', a.category || ' ' || p.hour, CAST(count(i.key) AS DOUBLE)
  FROM (SELECT DISTINCT category FROM incidents) a CROSS JOIN (SELECT DISTINCT hour FROM incidents) p
  LEFT JOIN incidents i ON i.category = a.category AND i.hour = p.hour GROUP BY a.category, p.hour
UNION ALL SELECT 'clusters', 'records', CAST(count(*) AS DOUBLE) FROM incidents
UNION ALL SELECT 'correlation', 'hour vs latitude', round(CAST(corr(hour, lat) AS DOUBLE), 6) FROM incidents
UNION ALL SELECT 'report', category, CAST(ceil(count(*) * 0.25::DOUBLE) AS DOUBLE) FROM incidents GROUP BY category
UNION ALL SELECT 'confusion', 'rows', (SELECT sum(ceil(n * 0.25::DOUBLE)) FROM (SELECT count(*) AS n FROM incidents GROUP BY category))
UNION ALL SELECT 'input', 'rows', CAST(count(*) AS DOUBLE) FROM events"""


@register("report_job", REPORT_SQL)
def q_report_job(spark, d):
    """What SQL can state of the written tables, the trained forest's included."""
    out = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    # Two readers, both open before either runs a job: the file is read once.
    source = (spark, f"{d.rstrip('/')}/events.parquet", "parquet", None, ("event_id", "event_type", "ts"))
    with shared_table(*source) as events, shared_table(*source) as raw:
        paths = build_report(fxt.incidents_of(events), ROLES, out)
        loaded = spark.createDataFrame([(raw.count(),)], "n long")
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    def part(name, item, value, rows):
        return rows.select(F.lit(name).alias("part"), item.alias("item"), value.cast("double").alias("value"))

    a, b = correlation.CORR_FEATURES[:2]
    rows = [
        part("hourly", F.col("hour").cast("string"), F.col("n"), read["hourly"]),
        part("heatmap", F.concat_ws(" ", "category", F.col("hour").cast("string")), F.col("n"), read["heatmap"]),
        part("clusters", F.lit("records"), F.col("n"), read["clusters"].agg(F.sum("records").alias("n"))),
        part("correlation", F.lit("hour vs latitude"), F.round("r", 6),
             read["correlation"].where((F.col("feature_a") == a) & (F.col("feature_b") == b))),
        part("report", F.col("label"), F.col("support"),
             read["report"].where(~F.col("label").isin("accuracy", "macro avg", "weighted avg"))),
        part("confusion", F.lit("rows"), F.col("n"), read["confusion"].agg(F.sum("n").alias("n"))),
        part("input", F.lit("rows"), F.col("n"), loaded),
    ]
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
@register("export_roundtrip", W(o.INCIDENTS) + "SELECT key, category, lat, lon, hour FROM incidents")
def q_export_roundtrip(spark, d):
    out = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    files.write_table(fxt.incidents(spark, d), out, "csv", columns=["key", "category", "lat", "lon", "hour"])
    return files.read_raw_csv(spark, out, EXPORT_SCHEMA)


@register("csv_missing_tokens", W(o.INCIDENTS_RAW) + f"""
SELECT key, category, CASE WHEN coalesce(day_raw, 'NA') IN ({', '.join(o.q(t) for t in NA_TOKENS)})
                           THEN NULL ELSE coalesce(day_raw, 'NA') END AS day_raw
FROM incidents_raw""")
def q_csv_missing_tokens(spark, d):
    raw = fxt.incidents_raw(spark, d).select("key", "category", F.coalesce("day_raw", F.lit("NA")).alias("day_raw"))
    out = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    files.write_table(raw, out, "csv")
    back = files.read_csv_na(spark, out, "key long, category string, day_raw string")
    return back


#: A token of each kind and near misses, dealt to the rows by key.
MIXED_FIELDS = [*NA_TOKENS, " NA ", "na", "7", "8.5", "-3"]
_mixed = "list_extract([" + ", ".join(o.q(t) for t in MIXED_FIELDS) + f"], {o.kint('field', len(MIXED_FIELDS), 'key')} + 1)"
_dealt = f"list_extract([{', '.join(o.q(t) for t in [*NA_TOKENS, '4', '5'])}], {o.kint('whole', len(NA_TOKENS) + 2, 'key')} + 1)"
_tokens = ", ".join(o.q(t) for t in NA_TOKENS)


@register("csv_inferred_types", W(o.INCIDENTS) + f"""
, f AS (SELECT key, {_mixed} AS mixed, {_dealt} AS whole FROM incidents)
SELECT key, CASE WHEN mixed IN ({_tokens}) THEN NULL ELSE mixed END AS mixed,
       CAST(CASE WHEN whole IN ({_tokens}) THEN NULL ELSE whole END AS BIGINT) AS whole FROM f""")
def q_csv_inferred_types(spark, d):
    def deal(seed, values):
        return F.element_at(F.array(*map(F.lit, values)), keyed_int(seed, len(values), "key") + 1)

    raw = fxt.incidents(spark, d).select("key", deal("field", MIXED_FIELDS).alias("mixed"),
                                         deal("whole", [*NA_TOKENS, "4", "5"]).alias("whole"))
    out = scratch_path(spark, f"inferred-{uuid.uuid4().hex}")
    files.write_table(raw, out, "csv")
    return files.read_csv_na(spark, out)


_SKETCHED = {"category": "category", "key": "CAST(key AS VARCHAR)", "place": "CAST(key % 977 AS VARCHAR)"}
_registers = " UNION ALL ".join(f"SELECT '{item}' AS item, {v} AS v FROM incidents_wide" for item, v in _SKETCHED.items())


@register("distinct_sketch", W(o.INCIDENTS_WIDE) + f"""
, every AS ({_registers})
, bits AS (SELECT item, v, ('0x' || substr(md5(v), 1, 3))::BIGINT AS register, ('0x' || substr(md5(v), 4, 13))::BIGINT AS bits FROM every WHERE v IS NOT NULL)
, regs AS (SELECT item, register, max(CASE WHEN bits > 0 THEN 53 - length(bin(bits)) ELSE 53 END) AS rank FROM bits GROUP BY item, register)
, sums AS (SELECT item, count(*) AS used, sum(pow(2.0::DOUBLE, -rank)) AS s FROM regs GROUP BY item)
, raw AS (SELECT item, used, (0.7213::DOUBLE / (1 + 1.079::DOUBLE / 4096)) * 4096 * 4096 / (s + 4096 - used) AS raw FROM sums)
SELECT item, (SELECT count(DISTINCT v) FROM every e WHERE e.item = raw.item) AS exact,
       round(CASE WHEN raw <= 2.5 * 4096 AND used < 4096 THEN 4096 * ln(4096 / (4096 - used)::DOUBLE) ELSE raw END, 6) AS estimate,
       true AS within_error, true AS parts_unite FROM raw""")
def q_distinct_sketch(spark, d):
    """Distinct counts from sketches of each hour, united, beside the exact ones."""
    wide = fxt.incidents_wide(spark, d)
    rows = []
    for item, value in {"category": F.col("category"), "key": F.col("key").cast("string"), "place": (F.col("key") % 977).cast("string")}.items():
        values = wide.select("hour", value.alias("v"))
        parts = sketch.merge_sketches(sketch.distinct_sketch(values, "v", ["hour"]))
        direct = sketch.sketch_estimate(sketch.distinct_sketch(values, "v"))
        both = sketch.sketch_estimate(parts).withColumns({"direct": direct.scalar(), "exact": values.agg(F.count_distinct("v")).scalar()})
        near = F.abs(F.col("estimate") - F.col("exact")) <= 4 * sketch.STANDARD_ERROR * F.col("exact") + 1
        rows.append(both.select(F.lit(item).alias("item"), "exact", F.round("estimate", 6).alias("estimate"), near.alias("within_error"),
                                (F.col("estimate") == F.col("direct")).alias("parts_unite")))
    return reduce(DataFrame.unionByName, rows)


#: Fields that read as missing, dealt to a third of the rows by key.
GAPS = ("", "NA", "NaN", "null")


@register("filtered_export", W(o.INCIDENTS_WIDE) + """
SELECT key, category, hour, day, lat, lon FROM incidents_wide WHERE hour BETWEEN 3 AND 20 AND regexp_matches(category, '^1', 'i')""")
def q_filtered_export(spark, d):
    """All columns of the filtered rows, as written."""
    out = scratch_path(spark, f"filtered-{uuid.uuid4().hex}")
    picked = filters.apply_filters(fxt.incidents_wide(spark, d), ROLES, FilterSpec(hour_range=(3, 20), search="^1"))
    files.write_table(picked, out, "csv")
    return files.read_raw_csv(spark, out, picked.schema)


@register("missing_category", W(o.INCIDENTS) + f"""
, f AS (SELECT *, list_extract([{', '.join(o.q(t) for t in GAPS)}], {o.kint('gap', 3 * len(GAPS), 'key')} + 1) AS gap FROM incidents)
SELECT key, CASE WHEN gap IS NULL THEN category ELSE {o.q(MISSING_CATEGORY)} END AS category, hour, lat, lon FROM f""")
def q_missing_category(spark, d):
    """Categories lost to missing-value tokens in a CSV file: their rows stay, with the text of a missing field."""
    rows = fxt.incidents(spark, d).select("key", "category", "lat", "lon", "hour")
    gap = F.try_element_at(F.array(*map(F.lit, GAPS)), keyed_int("gap", 3 * len(GAPS), "key") + 1)
    out = scratch_path(spark, f"gaps-{uuid.uuid4().hex}")
    files.write_table(rows.withColumn("category", F.coalesce(gap, "category")), out, "csv")
    back = clean.coerce_incidents(files.read_csv_na(spark, out, EXPORT_SCHEMA), ROLES)
    return back.select("key", "category", "hour", "lat", "lon")


__all__ = ["PrepareResult", "RAW_ROLES", "build_report", "prepare"]
