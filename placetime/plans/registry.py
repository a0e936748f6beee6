"""Registered queries: one per operator of the inventory, each with its SQL
twin (where SQL can express it) for the DuckDB oracle.

Every query reads the whole test tables (through the adapter views) and
returns a DataFrame; nothing is collected.  Float outputs are rounded to 6
places on both sides.  Ordered outputs carry a ``pos`` column, because the
comparison is order-insensitive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as fx
from ..functions.hashing import keyed_int, keyed_range, keyed_uniform
from ..operators import aggregates as agg
from ..operators import clean, correlation, filters, grow, metrics, ml, pivot, predict, replicate, sort, spatial, split, trees
from ..operators.joins import shuffle_partitions
from ..roles import (
    DAY_NAMES,
    LAT_LOW,
    LAT_WIDTH,
    LON_LOW,
    LON_WIDTH,
    MAP_ALL,
    MAP_INTENSITY,
    MAP_TYPE,
    MISSING_CATEGORY,
    SORT_CATEGORY,
    SORT_FREQUENCY,
    SORT_HOUR_ASC,
    SORT_HOUR_DESC,
    TIME_BANDS,
    ColumnRoles,
    FilterSpec,
)
from ..sources import fixtures as fxt
from . import oracle as o

R = 6  # decimal places for float outputs
ROLES = fxt.INCIDENT_ROLES
RAW_ROLES = ColumnRoles(category="category", lat="lat_raw", lon="lon", hour="hour_raw", day="day_raw", key="key")

# Query parameters (fixed, part of each query's definition).
SEARCH_TEXT = "CL|vi"
CHAIN_CATEGORIES = tuple(str(i) for i in range(0, 100, 3))
CHAIN_HOURS = (3, 20)
CHAIN_SEARCH = "^1"
PLACE_TERM = "NATION_1"
PLACE_PATTERN = "nation_2"
PROBE_TERM = "SMALL"
PREVIEW_ROWS = 25
# Six fixed centers for the nearest-center queries (the model is a parameter).
CENTERS = ((28.5, 77.1), (28.5, 77.4), (28.65, 77.25), (28.8, 77.1), (28.8, 77.4), (28.6139, 77.209))

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rnd(c) -> F.Column:
    return F.round(c if not isinstance(c, str) else F.col(c), R)


def _inc(spark, d):
    return fxt.incidents(spark, d)


def _wide(spark, d):
    return fxt.incidents_wide(spark, d)


def _clean_raw(spark, d) -> DataFrame:
    raw = fxt.incidents_raw(spark, d)
    c = clean.coerce_incidents(raw, RAW_ROLES)
    return c.select("key", "category", F.col("hour_raw").alias("hour"), F.col("lat_raw").alias("lat"), "lon", "day_raw")


W = o.with_
CLEAN_RAW_SQL = f"""clean_raw AS (
  SELECT key, coalesce(category, {o.q(MISSING_CATEGORY)}) AS category, {o.clip_hour('hour_raw')} AS hour, lat_raw AS lat, lon, day_raw FROM incidents_raw
  WHERE hour_raw IS NOT NULL AND NOT isnan(hour_raw) AND isfinite(hour_raw)
    AND lat_raw IS NOT NULL AND NOT isnan(lat_raw) AND lon IS NOT NULL AND NOT isnan(lon))"""


# ---------------------------------------------------------------------------
# Step 1: slice — clean, hour range, dense hourly counts, trailing mean
# ---------------------------------------------------------------------------
@register("hourly_trend", W(o.INCIDENTS, o.HOURS) + f"""
, c AS (SELECT hour, count(*) AS n FROM incidents GROUP BY hour)
, h AS (SELECT hours.hour, coalesce(c.n, 0) AS n FROM hours LEFT JOIN c USING (hour))
SELECT hour, n, round(avg(n) OVER (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), {R}) AS rolling_avg FROM h""")
def q_hourly_trend(spark, d):
    f = clean.coerce_incidents(_inc(spark, d), ROLES)
    return agg.hourly_trend(f, "hour").withColumn("rolling_avg", rnd("rolling_avg"))


@register("clean_rows", W(o.INCIDENTS_RAW, CLEAN_RAW_SQL) + "SELECT key, category, hour, lat, lon FROM clean_raw")
def q_clean_rows(spark, d):
    return _clean_raw(spark, d).select("key", "category", "hour", "lat", "lon")


@register("drop_any_null", W(o.INCIDENTS_RAW) + """
SELECT key, category, hour_raw, lat_raw, lon, day_raw FROM incidents_raw
WHERE key IS NOT NULL AND category IS NOT NULL AND hour_raw IS NOT NULL AND NOT isnan(hour_raw)
  AND lat_raw IS NOT NULL AND NOT isnan(lat_raw) AND lon IS NOT NULL AND NOT isnan(lon) AND day_raw IS NOT NULL""")
def q_drop_any_null(spark, d):
    return clean.drop_any_null(fxt.incidents_raw(spark, d))


@register("enrich_rows", W(o.INCIDENTS_RAW, CLEAN_RAW_SQL) + f"""
SELECT key, hour, {o.time_band('hour')} AS time_band, round({o.hsin('hour')}, {R}) AS hour_sin,
       round({o.hcos('hour')}, {R}) AS hour_cos,
       coalesce({o.normalize_day('day_raw')}, {o.keyed_day('day', 'key')}) AS day
FROM clean_raw""")
def q_enrich_rows(spark, d):
    e = clean.enrich(_clean_raw(spark, d), ROLES.with_day("day_raw"))
    return e.select("key", "hour", "time_band", rnd("hour_sin").alias("hour_sin"),
                    rnd("hour_cos").alias("hour_cos"), "day")


# ---------------------------------------------------------------------------
# Step 2: filters and sorts
# ---------------------------------------------------------------------------
_chain_in = ", ".join(o.q(c) for c in CHAIN_CATEGORIES)


@register("filter_chain", W(o.INCIDENTS_WIDE) + f"""
SELECT key, category, hour, row_number() OVER (ORDER BY hour, category, key) AS pos FROM incidents_wide
WHERE category IN ({_chain_in}) AND hour BETWEEN {CHAIN_HOURS[0]} AND {CHAIN_HOURS[1]}
  AND regexp_matches(category, {o.q(CHAIN_SEARCH)}, 'i')""")
def q_filter_chain(spark, d):
    spec = FilterSpec(categories=CHAIN_CATEGORIES, hour_range=CHAIN_HOURS, search=CHAIN_SEARCH)
    f = filters.apply_filters(_wide(spark, d), ROLES, spec).select("key", "category", "hour")
    return sort.sorted_with_position(f, ROLES, SORT_HOUR_ASC)


@register("place_filter", W(o.INCIDENTS_PLACE) + f"""
SELECT key, category, nation, hour FROM incidents_place WHERE strpos(nation, {o.q(PLACE_TERM)}) > 0""")
def q_place_filter(spark, d):
    p = fxt.incidents_place(spark, d)
    return filters.place_filter(p, "nation", PLACE_TERM).select("key", "category", "nation", "hour")


@register("place_filter_ci", W(o.INCIDENTS_PLACE) + f"""
SELECT key, category, nation, hour FROM incidents_place WHERE regexp_matches(nation, {o.q(PLACE_PATTERN)}, 'i')""")
def q_place_filter_ci(spark, d):
    p = fxt.incidents_place(spark, d)
    return filters.place_filter(p, "nation", PLACE_PATTERN, case_sensitive=False, regex=True).select(
        "key", "category", "nation", "hour")


_t = o.q(PROBE_TERM)


@register("first_string_match", f"""
WITH probe AS (SELECT coalesce(bool_or(strpos(p_name, {_t}) > 0), false) AS a,
                      coalesce(bool_or(strpos(p_brand, {_t}) > 0), false) AS b,
                      coalesce(bool_or(strpos(p_type, {_t}) > 0), false) AS c FROM part)
SELECT p_partkey, p_name, p_brand, p_type,
       CASE WHEN a THEN 'p_name' WHEN b THEN 'p_brand' WHEN c THEN 'p_type' END AS matched_column
FROM part, probe
WHERE CASE WHEN a THEN coalesce(strpos(p_name, {_t}) > 0, false) WHEN b THEN coalesce(strpos(p_brand, {_t}) > 0, false)
           WHEN c THEN coalesce(strpos(p_type, {_t}) > 0, false) ELSE true END""")
def q_first_string_match(spark, d):
    p = fxt.parts(spark, d).select("p_partkey", "p_name", "p_brand", "p_type")
    out, col = filters.first_string_match(p, PROBE_TERM)
    return out.withColumn("matched_column", F.lit(col).cast("string"))


@register("category_search", W(o.INCIDENTS) + f"""
SELECT key, category, hour FROM incidents WHERE regexp_matches(category, {o.q(SEARCH_TEXT)}, 'i')""")
def q_category_search(spark, d):
    return filters.category_search(_inc(spark, d), "category", f"  {SEARCH_TEXT} ").select("key", "category", "hour")


def _sort_sql(order: str, extra: str = "") -> str:
    return W(o.INCIDENTS) + f"""
SELECT key, category, hour, row_number() OVER (ORDER BY {order}) AS pos
FROM (SELECT *{extra} FROM incidents)"""


@register("sort_hour_asc", _sort_sql("hour, category, key"))
def q_sort_hour_asc(spark, d):
    return sort.sorted_with_position(_inc(spark, d).select("key", "category", "hour"), ROLES, SORT_HOUR_ASC)


@register("sort_hour_desc", _sort_sql("hour DESC, category, key"))
def q_sort_hour_desc(spark, d):
    return sort.sorted_with_position(_inc(spark, d).select("key", "category", "hour"), ROLES, SORT_HOUR_DESC)


@register("sort_category", _sort_sql("category, hour, key"))
def q_sort_category(spark, d):
    return sort.sorted_with_position(_inc(spark, d).select("key", "category", "hour"), ROLES, SORT_CATEGORY)


@register("sort_frequency", W(o.INCIDENTS_WIDE) + """
SELECT key, category, hour, row_number() OVER (ORDER BY freq DESC, hour, key) AS pos
FROM (SELECT *, count(*) OVER (PARTITION BY category) AS freq FROM incidents_wide)""")
def q_sort_frequency(spark, d):
    return sort.sorted_with_position(_wide(spark, d).select("key", "category", "hour"), ROLES, SORT_FREQUENCY)


@register("preview", W(o.INCIDENTS) + f"""
SELECT key, category, hour, row_number() OVER (ORDER BY hour, category, key) AS pos
FROM (SELECT * FROM incidents ORDER BY hour, category, key LIMIT {PREVIEW_ROWS})""")
def q_preview(spark, d):
    return sort.preview(_inc(spark, d), ROLES, PREVIEW_ROWS, ["key", "category", "hour"])


@register("filtered_preview", W(o.INCIDENTS_WIDE) + f"""
SELECT key, category, hour, row_number() OVER (ORDER BY hour, category, key) AS pos
FROM (SELECT * FROM incidents_wide WHERE category IN ({_chain_in}) AND hour BETWEEN {CHAIN_HOURS[0]} AND {CHAIN_HOURS[1]}
        AND regexp_matches(category, {o.q(CHAIN_SEARCH)}, 'i') ORDER BY hour, category, key LIMIT {PREVIEW_ROWS})""")
def q_filtered_preview(spark, d):
    spec = FilterSpec(categories=CHAIN_CATEGORIES, hour_range=CHAIN_HOURS, search=CHAIN_SEARCH)
    return sort.preview(filters.apply_filters(_wide(spark, d), ROLES, spec), ROLES, PREVIEW_ROWS, ["key", "category", "hour"])


@register("category_frequency", W(o.INCIDENTS_WIDE) + """
SELECT key, category, count(*) OVER (PARTITION BY category) AS freq FROM incidents_wide""")
def q_category_frequency(spark, d):
    return sort.category_frequency(_wide(spark, d).select("key", "category"), "category")


# ---------------------------------------------------------------------------
# Step 3: aggregates
# ---------------------------------------------------------------------------
@register("category_counts", W(o.INCIDENTS_WIDE) + """
SELECT category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS pos
FROM incidents_wide GROUP BY category""")
def q_category_counts(spark, d):
    return agg.ranked_counts(_wide(spark, d), "category")


def _topk_sql(k: int) -> str:
    return W(o.INCIDENTS_WIDE) + f"""
SELECT category, n, row_number() OVER (ORDER BY n DESC, category) AS pos FROM (
  SELECT category, count(*) AS n FROM incidents_wide GROUP BY category ORDER BY n DESC, category LIMIT {k})"""


@register("top5", _topk_sql(5))
def q_top5(spark, d):
    return agg.top_k(_wide(spark, d), "category", 5)


@register("top10", _topk_sql(10))
def q_top10(spark, d):
    return agg.top_k(_wide(spark, d), "category", 10)


@register("category_share", W(o.INCIDENTS_WIDE) + f"""
SELECT category, count(*) AS n, round(count(*) / (SELECT count(*) FROM incidents_wide)::DOUBLE, {R}) AS share
FROM incidents_wide GROUP BY category""")
def q_category_share(spark, d):
    return agg.category_share(_wide(spark, d), "category").withColumn("share", rnd("share"))


@register("top10_share", W(o.INCIDENTS_WIDE) + f"""
, t AS (SELECT category, count(*) AS n FROM incidents_wide GROUP BY category ORDER BY n DESC, category LIMIT 10)
SELECT category, n, round(n / (SELECT sum(n) FROM t)::DOUBLE, {R}) AS share,
       row_number() OVER (ORDER BY n DESC, category) AS pos FROM t""")
def q_top10_share(spark, d):
    return agg.top_k_share(_wide(spark, d), "category", 10).withColumn("share", rnd("share"))


@register("top_category", W(o.INCIDENTS_WIDE) + f"""
SELECT category, round(count(*) / (SELECT count(*) FROM incidents_wide)::DOUBLE, {R}) AS share
FROM incidents_wide GROUP BY category ORDER BY count(*) DESC, category LIMIT 1""")
def q_top_category(spark, d):
    return agg.top_category(_wide(spark, d), "category").withColumn("share", rnd("share"))


@register("hourly_counts", W(o.INCIDENTS, o.HOURS) + """
, c AS (SELECT hour, count(*) AS n FROM incidents GROUP BY hour)
SELECT hours.hour, coalesce(c.n, 0) AS n FROM hours LEFT JOIN c USING (hour)""")
def q_hourly_counts(spark, d):
    return agg.hourly_counts(_inc(spark, d), "hour")


def _dense_sql(where: str) -> str:
    return W(o.INCIDENTS, o.HOURS) + f"""
, f AS (SELECT * FROM incidents WHERE {where})
, c AS (SELECT hour, count(*) AS n FROM f GROUP BY hour)
, h AS (SELECT hours.hour, coalesce(c.n, 0) AS n FROM hours LEFT JOIN c USING (hour))
, pk AS (SELECT hour AS peak_hour FROM h ORDER BY n DESC, hour LIMIT 1)
, lt AS (SELECT hour AS least_hour FROM h ORDER BY n, hour LIMIT 1)
"""


@register("summary_stats", _dense_sql("true") + """
, tot AS (SELECT count(*) AS total, count(DISTINCT category) AS nd FROM f)
SELECT 'Total Crimes' AS metric, total AS value FROM tot
UNION ALL SELECT 'Unique Crime Types', nd FROM tot WHERE total > 0
UNION ALL SELECT 'Peak Crime Hour', CAST(peak_hour AS BIGINT) FROM pk, tot WHERE total > 0
UNION ALL SELECT 'Least Crime Hour', CAST(least_hour AS BIGINT) FROM lt, tot WHERE total > 0""")
def q_summary_stats(spark, d):
    return agg.summary_stats(_inc(spark, d), "category", "hour")


@register("peak_least_hour", _dense_sql("true") + """
SELECT peak_hour, least_hour FROM pk, lt""")
def q_peak_least_hour(spark, d):
    return agg.peak_least_hour(agg.hourly_counts(_inc(spark, d), "hour"), "hour")


@register("peak_hour_present", W(o.INCIDENTS_WIDE) + """
SELECT hour AS peak_hour FROM (SELECT hour, count(*) AS n FROM incidents_wide GROUP BY hour)
ORDER BY n DESC, hour LIMIT 1""")
def q_peak_hour_present(spark, d):
    return agg.peak_hour_present(_wide(spark, d), "hour")


@register("hour_probability", W(o.INCIDENTS, o.HOURS) + f"""
, c AS (SELECT hour, count(*) AS n FROM incidents GROUP BY hour)
, h AS (SELECT hours.hour, coalesce(c.n, 0) AS n FROM hours LEFT JOIN c USING (hour))
SELECT hour, n, round(coalesce(n / nullif(sum(n) OVER (), 0)::DOUBLE, 0.0), {R}) AS probability FROM h""")
def q_hour_probability(spark, d):
    return agg.hour_probability(_inc(spark, d), "hour").withColumn("probability", rnd("probability"))


@register("centroid", W(o.INCIDENTS) + f"""
SELECT round(avg(lat), {R}) AS avg_lat, round(avg(lon), {R}) AS avg_lon FROM incidents""")
def q_centroid(spark, d):
    c = agg.centroid(_inc(spark, d), "lat", "lon")
    return c.select(rnd("avg_lat").alias("avg_lat"), rnd("avg_lon").alias("avg_lon"))


@register("distinct_hours", W(o.INCIDENTS_WIDE) + """
SELECT hour, row_number() OVER (ORDER BY hour) AS pos FROM (SELECT DISTINCT hour FROM incidents_wide)""")
def q_distinct_hours(spark, d):
    return agg.distinct_sorted(_wide(spark, d), "hour")


@register("distinct_categories", W(o.INCIDENTS_WIDE) + """
SELECT category, row_number() OVER (ORDER BY category) AS pos FROM (SELECT DISTINCT category FROM incidents_wide)""")
def q_distinct_categories(spark, d):
    return agg.distinct_sorted(_wide(spark, d), "category")


@register("row_stats", W(o.INCIDENTS_WIDE) + """
SELECT count(*) AS n_rows, count(DISTINCT category) AS n_categories, min(hour) AS min_hour, max(hour) AS max_hour,
       (SELECT count(*) FROM (SELECT DISTINCT lat, lon FROM incidents_wide)) AS n_points,
       (SELECT min(n) FROM (SELECT count(*) AS n FROM incidents_wide GROUP BY category)) AS min_class
FROM incidents_wide""")
def q_row_stats(spark, d):
    return agg.row_stats(_wide(spark, d), "category", "hour", "lat", "lon")


# ---------------------------------------------------------------------------
# Step 4: scalar features, keyed draws, replication
# ---------------------------------------------------------------------------
@register("keyed_uniform", W(o.INCIDENTS) + f"""
SELECT key, {o.krange('lat', LAT_LOW, LAT_WIDTH, 'key')} AS lat, {o.krange('lon', LON_LOW, LON_WIDTH, 'key')} AS lon,
       {o.kint('hour', 24, 'key')} AS hour_draw, round({o.u('u', 'key')}, {R}) AS u FROM incidents""")
def q_keyed_uniform(spark, d):
    return _inc(spark, d).select(
        "key",
        keyed_range("lat", LAT_LOW, LAT_WIDTH, "key").alias("lat"),
        keyed_range("lon", LON_LOW, LON_WIDTH, "key").alias("lon"),
        keyed_int("hour", 24, "key").alias("hour_draw"),
        rnd(keyed_uniform("u", "key")).alias("u"),
    )


@register("time_band", W(o.INCIDENTS) + f"SELECT key, hour, {o.time_band('hour')} AS time_band FROM incidents")
def q_time_band(spark, d):
    return _inc(spark, d).select("key", "hour", fx.time_band("hour").alias("time_band"))


@register("cyclic_hour", W(o.INCIDENTS) + f"""
SELECT key, hour, round({o.hsin('hour')}, {R}) AS hour_sin, round({o.hcos('hour')}, {R}) AS hour_cos FROM incidents""")
def q_cyclic_hour(spark, d):
    return _inc(spark, d).select("key", "hour", rnd(fx.hour_sin("hour")).alias("hour_sin"),
                                 rnd(fx.hour_cos("hour")).alias("hour_cos"))


@register("day_normalize", W(o.INCIDENTS_RAW) + f"""
SELECT key, day_raw, {o.normalize_day('day_raw')} AS day FROM incidents_raw""")
def q_day_normalize(spark, d):
    return fxt.incidents_raw(spark, d).select("key", "day_raw", fx.normalize_day("day_raw").alias("day"))


@register("day_impute", W(o.INCIDENTS_RAW) + f"""
SELECT key, coalesce({o.normalize_day('day_raw')}, {o.keyed_day('day', 'key')}) AS day FROM incidents_raw""")
def q_day_impute(spark, d):
    return clean.complete_day(fxt.incidents_raw(spark, d), RAW_ROLES).select("key", "day")


@register("ordinal_codes", W(o.INCIDENTS) + f"""
SELECT key, {o.code('day', DAY_NAMES)} AS day_code, {o.code(o.time_band('hour'), TIME_BANDS)} AS time_code FROM incidents""")
def q_ordinal_codes(spark, d):
    i = _inc(spark, d)
    return i.select("key", fx.day_code("day").alias("day_code"), fx.time_code(fx.time_band("hour")).alias("time_code"))


@register("hour_intensity", W(o.INCIDENTS) + f"SELECT key, hour, {o.intensity('hour')} AS intensity FROM incidents")
def q_hour_intensity(spark, d):
    return _inc(spark, d).select("key", "hour", fx.hour_intensity("hour").alias("intensity"))


@register("replicate3", W(o.INCIDENTS) + f"""
SELECT key, copy, category, {o.krange('lat', LAT_LOW, LAT_WIDTH, 'key', 'copy')} AS lat,
       {o.krange('lon', LON_LOW, LON_WIDTH, 'key', 'copy')} AS lon, {o.kint('hour', 24, 'key', 'copy')} AS hour
FROM (SELECT key, category, CAST(c.range AS INTEGER) AS copy FROM incidents, range(1, 4) c)""")
def q_replicate3(spark, d):
    rep = replicate.replicate(_inc(spark, d).select("key", "category"), 3)
    return replicate.simulate_place_time(rep, ROLES).select("key", "copy", "category", "lat", "lon", "hour")


# ---------------------------------------------------------------------------
# Step 5: matrices, grid, slots, legends, map points
# ---------------------------------------------------------------------------
@register("pivot_long", W(o.INCIDENTS_WIDE) + "SELECT category, hour, count(*) AS n FROM incidents_wide GROUP BY category, hour")
def q_pivot_long(spark, d):
    return pivot.pivot_long(_wide(spark, d), "category", "hour")


@register("pivot_wide", W(o.INCIDENTS) + "SELECT category, " + ", ".join(
    f"count(*) FILTER (WHERE hour = {h}) AS h{h}" for h in range(24)) + " FROM incidents GROUP BY category")
def q_pivot_wide(spark, d):
    return pivot.pivot_wide(_inc(spark, d), "category", "hour")


@register("heatmap_normalized", W(o.INCIDENTS_WIDE) + f"""
, f AS (SELECT * FROM incidents_wide)
, cells AS (SELECT category, hour, count(*) AS n FROM f GROUP BY category, hour)
, per AS (SELECT category, sum(n) AS total, max(n) AS mx FROM cells GROUP BY category)
, hrs AS (SELECT DISTINCT hour FROM f)
, ranks AS (SELECT category, row_number() OVER (ORDER BY total DESC, category) AS row_order FROM per)
SELECT per.category, hrs.hour, coalesce(cells.n, 0) AS n,
       round(coalesce(cells.n, 0) / greatest(per.mx, 1)::DOUBLE, {R}) AS value, ranks.row_order
FROM per CROSS JOIN hrs LEFT JOIN cells ON cells.category = per.category AND cells.hour = hrs.hour
JOIN ranks ON ranks.category = per.category""")
def q_heatmap_normalized(spark, d):
    return pivot.heatmap_normalized(_wide(spark, d), "category", "hour").withColumn("value", rnd("value"))


@register("density_grid", W(o.INCIDENTS) + """
, e AS (SELECT min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM incidents)
SELECT CAST(CASE WHEN x1 = x0 THEN 15 ELSE least(floor((lon - x0) / (x1 - x0) * 30), 29) END AS INTEGER) AS x_bin,
       CAST(CASE WHEN y1 = y0 THEN 15 ELSE least(floor((lat - y0) / (y1 - y0) * 30), 29) END AS INTEGER) AS y_bin,
       count(*) AS n
FROM incidents, e GROUP BY ALL""")
def q_density_grid(spark, d):
    return spatial.density_grid(_inc(spark, d), "lon", "lat")


@register("category_slot", W(o.INCIDENTS_WIDE) + """
SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS BIGINT) AS idx,
       CAST((row_number() OVER (ORDER BY category) - 1) % 10 AS INTEGER) AS slot
FROM (SELECT DISTINCT category FROM incidents_wide)""")
def q_category_slot(spark, d):
    return spatial.category_slots(_wide(spark, d), "category").withColumn("idx", F.col("idx").cast("long"))


@register("cluster_slot", W(o.INCIDENTS_WIDE) + """
SELECT category, CAST(row_number() OVER (ORDER BY CAST(category AS BIGINT), category) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT category FROM incidents_wide)""")
def q_cluster_slot(spark, d):
    return spatial.cluster_slots(_wide(spark, d), "category")


@register("map_points_all", W(o.INCIDENTS) + "SELECT category, lat, lon, hour FROM incidents")
def q_map_points_all(spark, d):
    return spatial.map_points(_inc(spark, d), ROLES, MAP_ALL)


@register("map_points_intensity", W(o.INCIDENTS) + f"SELECT category, lat, lon, hour, {o.intensity('hour')} AS intensity FROM incidents")
def q_map_points_intensity(spark, d):
    return spatial.map_points(_inc(spark, d), ROLES, MAP_INTENSITY)


@register("map_points_type", W(o.INCIDENTS_WIDE) + """
, s AS (SELECT category, CAST((row_number() OVER (ORDER BY category) - 1) % 10 AS INTEGER) AS slot
        FROM (SELECT DISTINCT category FROM incidents_wide))
SELECT category, lat, lon, hour, slot FROM incidents_wide JOIN s USING (category)""")
def q_map_points_type(spark, d):
    return spatial.map_points(_wide(spark, d), ROLES, MAP_TYPE)


@register("legend_type", W(o.INCIDENTS_WIDE) + """
SELECT category AS label, CAST((pos - 1) % 10 AS INTEGER) AS slot, pos FROM (
  SELECT category, row_number() OVER (ORDER BY category) AS pos FROM (SELECT DISTINCT category FROM incidents_wide))
WHERE pos <= 12""")
def q_legend_type(spark, d):
    return spatial.legend(_wide(spark, d), ROLES, MAP_TYPE)


@register("legend_intensity", W(o.INCIDENTS) + """
SELECT label, slot, pos FROM (VALUES ('Low (0-8)', 0, 1::BIGINT), ('Medium (9-16)', 1, 2::BIGINT), ('High (17-23)', 2, 3::BIGINT)) t(label, slot, pos)
WHERE (SELECT count(*) FROM incidents) > 0""")
def q_legend_intensity(spark, d):
    return spatial.legend(_inc(spark, d), ROLES, MAP_INTENSITY)


@register("legend_all", W(o.INCIDENTS) + """
SELECT 'All Crimes' AS label, 0 AS slot, 1::BIGINT AS pos WHERE (SELECT count(*) FROM incidents) > 0""")
def q_legend_all(spark, d):
    return spatial.legend(_inc(spark, d), ROLES, MAP_ALL)


# ---------------------------------------------------------------------------
# Step 6: correlation
# ---------------------------------------------------------------------------
_FEATS = correlation.CORR_FEATURES
CORR_FRAME_SQL = f"""cf AS (
  SELECT CAST(hour AS DOUBLE) AS f0, lat AS f1, lon AS f2, {o.hsin('hour')} AS f3, {o.hcos('hour')} AS f4,
         {o.code('day', DAY_NAMES)} AS f5, {o.code(o.time_band('hour'), TIME_BANDS)} AS f6,
         CAST({o.nearest('lat', 'lon', CENTERS)} AS DOUBLE) AS f7
  FROM incidents)"""


def _corr_pairs_sql() -> str:
    sel = []
    for i in range(8):
        for j in range(8):
            a, b = min(i, j), max(i, j)
            r = (f"CASE WHEN stddev_pop(f{a}) * stddev_pop(f{b}) = 0 THEN NULL "
                 f"ELSE covar_pop(f{a}, f{b}) / (stddev_pop(f{a}) * stddev_pop(f{b})) END")
            sel.append(f"SELECT {o.q(_FEATS[i])} AS feature_a, {o.q(_FEATS[j])} AS feature_b, {i} AS i, {j} AS j, "
                       f"round({r}, {R}) AS r FROM cf")
    return "\nUNION ALL ".join(sel)


def _corr_frame(spark, d):
    i = _inc(spark, d).withColumn("time_band", fx.time_band("hour"))
    i = spatial.assign_centers(i, "lat", "lon", CENTERS)
    return correlation.correlation_frame(i, "hour", "lat", "lon", "day", "time_band", "cluster")


@register("corr_matrix", W(o.INCIDENTS, CORR_FRAME_SQL) + _corr_pairs_sql())
def q_corr_matrix(spark, d):
    m = correlation.corr_matrix(_corr_frame(spark, d))
    return m.withColumn("r", rnd("r"))


@register("strongest_pairs", W(o.INCIDENTS, CORR_FRAME_SQL) + ", m AS (" + _corr_pairs_sql() + f""")
SELECT feature_a || ' vs ' || feature_b AS pair, r, row_number() OVER (ORDER BY abs(r) DESC, i, j) AS pos
FROM m WHERE i < j AND r IS NOT NULL ORDER BY abs(r) DESC, i, j LIMIT 5""")
def q_strongest_pairs(spark, d):
    m = correlation.corr_matrix(_corr_frame(spark, d)).withColumn("r", rnd("r"))
    return correlation.strongest_pairs(m, 5)


@register("hour_count_corr", W(o.INCIDENTS, o.HOURS) + f"""
, c AS (SELECT hour, count(*) AS n FROM incidents GROUP BY hour)
, h AS (SELECT CAST(hours.hour AS DOUBLE) AS hour, CAST(coalesce(c.n, 0) AS DOUBLE) AS n FROM hours LEFT JOIN c USING (hour))
SELECT round(CASE WHEN stddev_pop(hour) * stddev_pop(n) = 0 THEN NULL
                  ELSE covar_pop(hour, n) / (stddev_pop(hour) * stddev_pop(n)) END, {R}) AS r FROM h""")
def q_hour_count_corr(spark, d):
    h = agg.hourly_counts(_inc(spark, d), "hour").select(F.col("hour").cast("double").alias("hour"), F.col("n").cast("double").alias("n"))
    return correlation.hour_count_corr(h, "hour", "n").withColumn("r", rnd("r"))


# ---------------------------------------------------------------------------
# Step 7: clustering
# ---------------------------------------------------------------------------
@register("cluster_count", W(o.INCIDENTS) + """
, a AS (SELECT count(*) AS n, coalesce(max(lat) > min(lat) OR max(lon) > min(lon), false) AS multi_point
        FROM incidents)
SELECT n, multi_point, CAST(CASE WHEN n < 3 OR NOT multi_point THEN 0
                                 ELSE least(least(6, greatest(2, n // 250 + 2)), n) END AS INTEGER) AS k FROM a""")
def q_cluster_count(spark, d):
    return spatial.cluster_plan(_inc(spark, d), "lat", "lon")


@register("nearest_center", W(o.INCIDENTS) + f"""
SELECT key, {o.nearest('lat', 'lon', CENTERS)} AS cluster, CAST({o.nearest('lat', 'lon', CENTERS)} AS VARCHAR) AS cluster_id
FROM incidents""")
def q_nearest_center(spark, d):
    return spatial.assign_centers(_inc(spark, d), "lat", "lon", CENTERS).select("key", "cluster", "cluster_id")


@register("cluster_summary", W(o.INCIDENTS) + f"""
SELECT cluster, count(*) AS records, round(avg(lat), {R}) AS avg_lat, round(avg(lon), {R}) AS avg_lon
FROM (SELECT *, {o.nearest('lat', 'lon', CENTERS)} AS cluster FROM incidents) GROUP BY cluster""")
def q_cluster_summary(spark, d):
    a = spatial.assign_centers(_inc(spark, d), "lat", "lon", CENTERS)
    s = spatial.cluster_summary(a, "cluster", "lat", "lon")
    return s.withColumns({"avg_lat": rnd("avg_lat"), "avg_lon": rnd("avg_lon")})


KMEANS_SQL = "WITH RECURSIVE " + ",\n".join([o.INCIDENTS, o.kmeans(restarts=spatial.KMEANS_RESTARTS)])


@register("kmeans_fit", KMEANS_SQL + f"""
SELECT CAST(cluster AS VARCHAR) AS cluster, round(lat, {R}) AS lat, round(lon, {R}) AS lon, round((SELECT sum(d) FROM near), {R}) AS cost FROM centers""")
def q_kmeans_fit(spark, d):
    _rows, fit = spatial.attach_clusters(_inc(spark, d), ROLES)
    cost = F.lit(fit.cost if fit else None).cast("double")
    return spatial.centers_frame(spark, fit).select("cluster", rnd("lat").alias("lat"), rnd("lon").alias("lon"), rnd(cost).alias("cost"))


@register("kmeans_fixed_point", W(o.INCIDENTS) + """
SELECT (SELECT least(least(6, greatest(2, count(*) // 250 + 2)), count(*)) FROM incidents) AS k, count(*) AS records, true AS at_mean FROM incidents""")
def q_kmeans_fixed_point(spark, d):
    """Whether each center is the mean of the rows nearest to it."""
    rows, fit = spatial.attach_clusters(_inc(spark, d), ROLES)
    means = spatial.cluster_summary(rows, "cluster_id", "lat", "lon").join(spatial.centers_frame(spark, fit), F.col("cluster_id") == F.col("cluster"), "full")
    off = F.greatest(F.abs(F.col("lat") - F.col("avg_lat")), F.abs(F.col("lon") - F.col("avg_lon")))
    return means.agg(F.count("cluster").alias("k"), F.sum("records").alias("records"), F.bool_and(F.coalesce(off < 1e-7, F.lit(False))).alias("at_mean"))


@register("attach_clusters", KMEANS_SQL + """
SELECT key, CAST(cluster AS VARCHAR) AS cluster_id, true AS nearest, (SELECT count(*) FROM centers) AS k FROM near""")
def q_attach_clusters(spark, d):
    """Each row's cluster, and whether no other center is nearer."""
    rows, fit = spatial.attach_clusters(_inc(spark, d), ROLES)
    centers = fit.centers if fit else []
    far = F.array(*[F.pow(F.col("lat") - F.lit(a), F.lit(2.0)) + F.pow(F.col("lon") - F.lit(b), F.lit(2.0)) for a, b in centers])
    own = F.element_at(far, F.col("cluster_id").cast("int") + 1)
    return rows.select("key", "cluster_id", (own <= F.array_min(far) + 1e-12).alias("nearest"), F.lit(len(centers)).cast("long").alias("k"))


# ---------------------------------------------------------------------------
# Step 8: labels, splits, imputation, metrics
# ---------------------------------------------------------------------------
@register("label_index_freq", W(o.INCIDENTS_WIDE) + """
, r AS (SELECT category, CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS DOUBLE) AS label
        FROM incidents_wide GROUP BY category)
SELECT key, category, label FROM incidents_wide JOIN r USING (category)""")
def q_label_index_freq(spark, d):
    return ml.index_labels(_wide(spark, d).select("key", "category"), "category", "label", "frequencyDesc")


@register("label_index_alpha", W(o.INCIDENTS_WIDE) + """
, r AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS DOUBLE) AS label
        FROM (SELECT DISTINCT category FROM incidents_wide))
SELECT key, category, label FROM incidents_wide JOIN r USING (category)""")
def q_label_index_alpha(spark, d):
    return ml.index_labels(_wide(spark, d).select("key", "category"), "category", "label", "alphabetAsc")


@register("keyed_split", W(o.INCIDENTS) + f"SELECT key, {o.u('split42', 'key')} < 0.2::DOUBLE AS is_test FROM incidents")
def q_keyed_split(spark, d):
    return split.keyed_split(_inc(spark, d).select("key"), "key", 0.2, 42)


@register("stratified_split", W(o.INCIDENTS_WIDE) + f"""
SELECT key, category,
       row_number() OVER (PARTITION BY category ORDER BY {o.word('split42', 'key')}, key)
         <= ceil(count(*) OVER (PARTITION BY category) * 0.25::DOUBLE) AS is_test
FROM incidents_wide""")
def q_stratified_split(spark, d):
    return split.stratified_split(_wide(spark, d).select("key", "category"), "category", "key", 0.25, 42)


@register("impute_mode", W(o.INCIDENTS_RAW) + f"""
, n AS (SELECT key, {o.normalize_day('day_raw')} AS day FROM incidents_raw)
, m AS (SELECT day FROM n WHERE day IS NOT NULL GROUP BY day ORDER BY count(*) DESC, day LIMIT 1)
SELECT key, coalesce(n.day, (SELECT day FROM m)) AS day FROM n""")
def q_impute_mode(spark, d):
    n = fxt.incidents_raw(spark, d).select("key", fx.normalize_day("day_raw").alias("day"))
    return ml.impute_mode(n, ["day"])


@register("accuracy", W(o.PREDICTIONS) + f"""
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE, {R}) AS accuracy FROM predictions""")
def q_accuracy(spark, d):
    return metrics.accuracy(fxt.predictions(spark, d)).withColumn("accuracy", rnd("accuracy"))


@register("confusion_matrix", W(o.PREDICTIONS) + """
, cls AS (SELECT label AS c FROM predictions UNION SELECT prediction FROM predictions)
, cells AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM predictions GROUP BY ALL)
SELECT a.c AS actual, p.c AS predicted, coalesce(cells.n, 0) AS n
FROM cls a CROSS JOIN cls p LEFT JOIN cells ON cells.actual = a.c AND cells.predicted = p.c""")
def q_confusion_matrix(spark, d):
    return metrics.confusion_matrix(fxt.predictions(spark, d))


@register("classification_report", W(o.PREDICTIONS) + f"""
, cls AS (SELECT label AS c FROM predictions UNION SELECT prediction FROM predictions)
, per AS (
  SELECT c AS label,
         (SELECT count(*) FROM predictions WHERE label = c AND prediction = c) AS tp,
         (SELECT count(*) FROM predictions WHERE prediction = c) AS pred_n,
         (SELECT count(*) FROM predictions WHERE label = c) AS support FROM cls)
, m AS (SELECT label, coalesce(tp / nullif(pred_n, 0)::DOUBLE, 0.0) AS precision,
               coalesce(tp / nullif(support, 0)::DOUBLE, 0.0) AS recall, CAST(support AS DOUBLE) AS support, tp FROM per)
, m2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM m)
, t AS (SELECT sum(support) AS total, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM m2)
, allrows AS (
  SELECT label, precision, recall, f1, support, 0 AS o FROM m2
  UNION ALL SELECT 'accuracy', tp / total, tp / total, tp / total, tp / total, 1 FROM t
  UNION ALL SELECT 'macro avg', mp, mr, mf, total, 2 FROM t
  UNION ALL SELECT 'weighted avg', wp / total, wr / total, wf / total, total, 3 FROM t)
SELECT label, round(precision, {R}) AS precision, round(recall, {R}) AS recall, round(f1, {R}) AS f1,
       round(support, {R}) AS support, row_number() OVER (ORDER BY o, label) AS pos FROM allrows""")
def q_classification_report(spark, d):
    r = metrics.classification_report(fxt.predictions(spark, d))
    return r.select("label", *[rnd(c).alias(c) for c in ("precision", "recall", "f1", "support")], "pos")


# ---------------------------------------------------------------------------
# Step 9: model, scenarios, baseline
# ---------------------------------------------------------------------------
@register("baseline_prediction", W(o.INCIDENTS_WIDE) + f"""
, f AS (SELECT * FROM incidents_wide)
SELECT category AS prediction, round(count(*) / (SELECT count(*) FROM f)::DOUBLE, {R}) AS confidence
FROM f GROUP BY category ORDER BY count(*) DESC, category LIMIT 1""")
def q_baseline_prediction(spark, d):
    return predict.baseline_prediction(_wide(spark, d), "category").withColumn("confidence", rnd("confidence"))


@register("scenario_features", W(o.INCIDENTS) + f"""
SELECT key, hour, round({o.hsin('hour')}, {R}) AS hour_sin, round({o.hcos('hour')}, {R}) AS hour_cos,
       {o.time_band('hour')} AS time_band, CAST({o.nearest('lat', 'lon', CENTERS)} AS VARCHAR) AS cluster_id
FROM incidents""")
def q_scenario_features(spark, d):
    pts = _inc(spark, d).select("key", "hour", "lat", "lon")
    f = predict.scenario_features(pts, centers=CENTERS)
    return f.select("key", "hour", rnd("hour_sin").alias("hour_sin"), rnd("hour_cos").alias("hour_cos"),
                    "time_band", "cluster_id")


@register("scenario_expand", W(o.INCIDENTS) + f"""
SELECT key, d.day, round(1.0 / 7, {R}) AS day_weight FROM incidents,
  (SELECT unnest({o.DAY_LIST}) AS day) d""")
def q_scenario_expand(spark, d):
    e = predict.expand_days(_inc(spark, d).select("key"))
    return e.withColumn("day_weight", rnd("day_weight"))


def _trained(spark, d):
    base = clean.prepare_base(_inc(spark, d), ROLES)
    clustered = spatial.assign_centers(base, "lat", "lon", CENTERS)
    return ml.train_classifier(clustered, "category", "key", "batch")


def _scored_per_class(res) -> DataFrame:
    """Per class: scored test rows, and whether all got a class that was trained on."""
    known = F.col("prediction").isin(res.classes)
    return res.predictions.groupBy("label").agg(F.count(F.lit(1)).alias("scored"), F.bool_and(known).alias("known"))


def _stratified_sql(fraction: float) -> str:
    return W(o.INCIDENTS) + f"""
SELECT category AS label, CAST(ceil(count(*) * {fraction}::DOUBLE) AS BIGINT) AS scored, true AS known
FROM incidents GROUP BY category"""


@register("forest_batch", W(o.INCIDENTS) + f"""
SELECT category AS label, count(*) AS scored, true AS known FROM incidents WHERE {o.u('split42', 'key')} < 0.2::DOUBLE
GROUP BY category""")
def q_forest_batch(spark, d):
    return _scored_per_class(ml.train_classifier(_inc(spark, d), "category", "key", "batch", ("lat", "lon", "hour"), ()))


@register("forest_dashboard", _stratified_sql(0.25))
def q_forest_dashboard(spark, d):
    base = spatial.assign_centers(clean.prepare_base(_inc(spark, d), ROLES), "lat", "lon", CENTERS)
    return _scored_per_class(ml.train_classifier(base, "category", "key", "dashboard"))


@register("forest_recovered", _stratified_sql(0.2))
def q_forest_recovered(spark, d):
    return _scored_per_class(ml.train_classifier(_inc(spark, d), "category", "key", "recovered", ("hour", "lat", "lon"), ()))


@register("importance_total", "SELECT 1.0::DOUBLE AS total, 8::BIGINT AS features")
def q_importance_total(spark, d):
    imp = ml.feature_importance(spark, _trained(spark, d))
    return imp.agg(F.round(F.sum("importance"), R).alias("total"), F.count(F.lit(1)).alias("features"))


@register("scenario_totals", W(o.INCIDENTS) + """
SELECT key, 1.0::DOUBLE AS total, (SELECT count(DISTINCT category) FROM incidents) AS classes, true AS ordered FROM incidents""")
def q_scenario_totals(spark, d):
    """Per point: probabilities sum to 1 over all classes, and rank 1 has the greatest."""
    res = _trained(spark, d)
    pts = predict.scenario_features(_inc(spark, d).select("key", "hour", "lat", "lon"), centers=CENTERS)
    _best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key")
    first = F.max(F.when(F.col("rank") == 1, F.col("probability")))
    return ranked.groupBy("key").agg(F.round(F.sum("probability"), R).alias("total"), F.count(F.lit(1)).alias("classes"),
                                     (first == F.max("probability")).alias("ordered"))


def _model_frame(spark, d) -> DataFrame:
    return spatial.assign_centers(clean.prepare_base(_inc(spark, d), ROLES), "lat", "lon", CENTERS)


def _scored(res, rows: DataFrame) -> DataFrame:
    """Rows with the features (``x``) and class probabilities (``p``) of the fitted pipeline."""
    from pyspark.ml.functions import vector_to_array

    for stage in res.model.stages[1:]:
        rows = stage.transform(rows)
    return rows.select(*[c for c in ("key", "day_weight") if c in rows.columns], vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"))


def _off(a: str, b: str) -> F.Column:
    """The greatest difference of two arrays; null if one is longer."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


@register("forest_values", W(o.INCIDENTS) + "SELECT key, true AS same, true AS varied FROM incidents")
def q_forest_values(spark, d):
    """Whether the trees, walked as a column expression, give each row the native forest's probabilities."""
    res = _trained(spark, d)
    rows = _scored(res, _model_frame(spark, d))
    nodes = trees.forest_nodes(spark, res.model.stages[-1])
    own = trees.forest_probability(nodes, "x", ml.PRESETS["batch"].max_depth)
    both = rows.withColumn("q", own)
    several = both.select("q").limit(100).agg(F.count_distinct("q") > 1).scalar()
    return both.select("key", F.coalesce(_off("p", "q") < 1e-9, F.lit(False)).alias("same"), several.alias("varied"))


_SLOTS_SQL = f"""5 + (SELECT count(DISTINCT {o.time_band('hour')}) + count(DISTINCT day) + count(DISTINCT {o.nearest('lat', 'lon', CENTERS)}) FROM incidents)"""


@register("importance_values", W(o.INCIDENTS) + f"""
SELECT CAST(range AS INTEGER) AS slot, true AS same, 1.0::DOUBLE AS total FROM range({_SLOTS_SQL})""")
def q_importance_values(spark, d):
    """Importances worked out from the trees' gains against the native forest's, slot by slot."""
    forest = _trained(spark, d).model.stages[-1]
    native = spark.createDataFrame(list(enumerate(forest.featureImportances.toArray().tolist())), "slot int, native double")
    own = trees.gain_importance(trees.forest_nodes(spark, forest))
    both = native.join(own, F.col("slot") == F.col("feature"), "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return both.select("slot", (F.abs(F.col("importance") - F.col("native")) < 1e-9).alias("same"),
                       F.round(both.agg(F.sum("importance")).scalar(), R).alias("total"))


@register("importance_ranks", W(o.INCIDENTS) + """
SELECT range + 1 AS pos, true AS same FROM range((SELECT 8 FROM incidents LIMIT 1))""")
def q_importance_ranks(spark, d):
    """Features by their summed importance against an order worked out from the trees' gains."""
    res = _trained(spark, d)
    ranked = sort.rank_small(ml.feature_importance(spark, res), [F.col("importance").desc(), F.col("feature").asc()])
    names = [n.split("__", 1)[1] for n in res.feature_names]
    base = [next((c for c in ml.CATEGORICAL_FEATURES if n.startswith(c + "_")), n) for n in names]
    own = trees.gain_importance(trees.forest_nodes(spark, res.model.stages[-1])).join(
        spark.createDataFrame(list(enumerate(base)), "feature int, base string"), "feature")
    order = sort.rank_small(own.groupBy("base").agg(F.sum("importance").alias("own")), [F.round("own", 12).desc(), F.col("base").asc()], "own_pos")
    both = ranked.join(order, F.col("feature") == F.col("base"), "left")
    return both.select("pos", F.coalesce((F.col("pos") == F.col("own_pos")) & (F.abs(F.col("own") - F.col("importance")) < 1e-9), F.lit(False)).alias("same"))


def _day_averages(res, pts: DataFrame) -> DataFrame:
    """(key, class, mean): the probabilities of the seven day rows of each point, averaged by a grouped aggregate."""
    rows = _scored(res, predict.expand_days(pts))
    classes = F.array(*[F.lit(c) for c in res.classes])
    each = rows.select("key", "day_weight", F.posexplode("p").alias("i", "v")).groupBy("key", "i").agg(F.sum(F.col("day_weight") * F.col("v")).alias("mean"))
    return each.select("key", F.element_at(classes, F.col("i") + 1).alias("class"), "mean")


def _scenarios_agree(spark, d, res) -> DataFrame:
    pts = predict.scenario_features(_inc(spark, d).select("key", "hour", "lat", "lon"), centers=CENTERS)
    best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key")
    # Seven rows of a point are preprocessed and scored: dealt evenly, like the points that score_scenarios takes.
    dealt = pts.repartition(shuffle_partitions(pts))
    both = ranked.join(_day_averages(res, dealt), ["key", "class"], "full").join(best, "key")
    near = F.coalesce(F.abs(F.col("probability") - F.col("mean")) < 1e-9, F.lit(False))
    return both.groupBy("key").agg(F.bool_and(near).alias("same"), F.count(F.lit(1)).alias("classes"),
                                   (F.max("confidence") == F.max("probability")).alias("best_is_greatest"),
                                   F.bool_or((F.col("class") == F.col("prediction")) & (F.col("rank") == 1)).alias("best_is_first"),
                                   # The ranks 1, 2, ... are those of the averaged probabilities, ties by class.
                                   (F.array_sort(F.collect_list(F.struct((-F.round("mean", 12)).alias("m"), F.col("class").alias("c"))))["c"]
                                    == F.array_sort(F.collect_list(F.struct("rank", F.col("class").alias("c"))))["c"]).alias("ranked"))


_SCENARIO_SQL = W(o.INCIDENTS) + """
SELECT key, true AS same, (SELECT count(DISTINCT category) FROM incidents) AS classes, true AS best_is_greatest, true AS best_is_first, true AS ranked FROM incidents"""


@register("scenario_values", _SCENARIO_SQL)
def q_scenario_values(spark, d):
    """Day-averaged scores of each point against the average of its seven scored day rows."""
    return _scenarios_agree(spark, d, _trained(spark, d))


@register("scenario_dashboard", _SCENARIO_SQL)
def q_scenario_dashboard(spark, d):
    """The same with the dashboard's forest, as the reference scores its scenarios."""
    return _scenarios_agree(spark, d, ml.train_classifier(_model_frame(spark, d), "category", "key", "dashboard"))


@register("train_record", W(o.INCIDENTS) + """
SELECT true AS ready, '' AS message, count(*) AS training_rows, CAST(count(DISTINCT category) AS INTEGER) AS n_classes, false AS stratified,
       true AS accuracy_of_predictions FROM incidents""")
def q_train_record(spark, d):
    """The training record; its accuracy against that of the written predictions."""
    res = _trained(spark, d)
    right = res.predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    return ml.status_frame(spark, res).select("ready", "message", "training_rows", "n_classes", "stratified",
                                             (F.abs(F.col("accuracy") - right) < 1e-12).alias("accuracy_of_predictions"))


BAG_TREES = 12
_copies = " + ".join(f"CASE WHEN u >= {p!r}::DOUBLE THEN 1 ELSE 0 END" for p in grow.POISSON)
_BAGS_SQL = W(o.INCIDENTS) + f"""
, drawn AS (SELECT t AS tree, category, {_copies} AS copies FROM (
    SELECT t, category, ('0x' || substr(md5('bag42-' || (t // 4) || '|' || key), 8 * (t % 4) + 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
    FROM incidents, (SELECT CAST(range AS INTEGER) AS t FROM range({BAG_TREES}))))
, sizes AS (SELECT tree, category, CAST(sum(copies) AS BIGINT) AS n, count(*) AS distinct_rows FROM drawn WHERE copies > 0 GROUP BY tree, category)
"""


@register("bag_weights", _BAGS_SQL + f"""
SELECT tree, category, n, round(sum(n) OVER (PARTITION BY tree) / (count(*) OVER (PARTITION BY tree) * n)::DOUBLE, {R}) AS weight FROM sizes""")
def q_bag_weights(spark, d):
    """Copies and weight of each class in each tree's bag."""
    bag = grow.bags(_inc(spark, d).select("key", "category"), "key", 0, BAG_TREES, 42)
    return grow.bag_weights(bag, "category", True).withColumn("weight", rnd("weight"))


@register("grown_roots", _BAGS_SQL + f"""
SELECT tree, CAST(sum(distinct_rows) AS BIGINT) AS rows, list(round(weight, {R}) ORDER BY category) AS weights FROM (
  SELECT *, sum(n) OVER (PARTITION BY tree) / count(*) OVER (PARTITION BY tree)::DOUBLE AS weight FROM sizes) GROUP BY tree""")
def q_grown_roots(spark, d):
    """What the roots of a grown forest hold: the rows of the bag, and balanced classes."""
    rows = ml.index_labels(_inc(spark, d), "category", "label", "alphabetAsc").select("key", "label", F.array("lat", "lon", F.col("hour").cast("double")).alias("x"))
    classes = rows.agg(F.max("label")).first()[0]
    nodes = grow.grow_forest(rows, "key", "label", "x", 3, int(classes) + 1, grow.Growth(BAG_TREES, 3, balanced=True))
    return nodes.where("node = 0").select("tree", "rows", F.transform("weights", lambda w: F.round(w, R)).alias("weights"))


@register("rf_train_score")
def q_rf_train_score(spark, d):
    return _trained(spark, d).predictions


@register("feature_importance")
def q_feature_importance(spark, d):
    imp = ml.feature_importance(spark, _trained(spark, d))
    return sort.rank_small(imp, [F.col("importance").desc(), F.col("feature").asc()])


@register("scenario_scores")
def q_scenario_scores(spark, d):
    res = _trained(spark, d)
    pts = predict.scenario_features(_inc(spark, d).select("key", "hour", "lat", "lon"), centers=CENTERS)
    best, _ranked = predict.score_scenarios(res.model, res.classes, pts, "key")
    return best


@register("scenario_top10")
def q_scenario_top10(spark, d):
    base = spatial.assign_centers(clean.prepare_base(_wide(spark, d), ROLES), "lat", "lon", CENTERS)
    res = ml.train_classifier(base, "category", "key", "batch")
    pts = predict.scenario_features(_inc(spark, d).select("key", "hour", "lat", "lon"), centers=CENTERS)
    _best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key", top=10)
    return predict.top_probabilities(ranked, 10)


@register("train_status")
def q_train_status(spark, d):
    base = clean.prepare_base(_inc(spark, d), ROLES)
    res = ml.train_classifier(spatial.assign_centers(base, "lat", "lon", CENTERS), "category", "key", "batch")
    return ml.status_frame(spark, res)


@register("impute_median", W(o.INCIDENTS_RAW) + f"""
SELECT key, round(coalesce(lat_raw, (SELECT median(lat_raw) FROM incidents_raw)), {R}) AS lat_raw FROM incidents_raw""")
def q_impute_median(spark, d):
    from ..operators import quantile

    raw = fxt.incidents_raw(spark, d).select("key", "lat_raw")
    return quantile.impute_median_exact(raw, ["lat_raw"]).withColumn("lat_raw", rnd("lat_raw"))


@register("one_hot_features", W(o.INCIDENTS) + f"""
, e AS (SELECT key, {o.time_band('hour')} AS time_band, day FROM incidents)
, b AS (SELECT list(DISTINCT time_band ORDER BY time_band) AS bands, list(DISTINCT day ORDER BY day) AS days FROM e)
SELECT key, time_band, day,
       list_transform(bands, lambda x: CASE WHEN x = time_band THEN 1.0 ELSE 0.0 END::DOUBLE) AS cat__time_band,
       list_transform(days, lambda x: CASE WHEN x = day THEN 1.0 ELSE 0.0 END::DOUBLE) AS cat__day
FROM e, b""")
def q_one_hot_features(spark, d):
    from pyspark.ml.functions import vector_to_array

    e = clean.enrich(_inc(spark, d), ROLES)
    oh = ml.one_hot(e, ["time_band", "day"])
    return oh.select("key", "time_band", "day", vector_to_array("cat__time_band").alias("cat__time_band"),
                     vector_to_array("cat__day").alias("cat__day"))


# ---------------------------------------------------------------------------
# More SQL-checked operator forms
# ---------------------------------------------------------------------------
@register("union_copies", W(o.INCIDENTS) + """
SELECT key, category FROM incidents UNION ALL SELECT key, category FROM incidents
UNION ALL SELECT key, category FROM incidents""")
def q_union_copies(spark, d):
    return replicate.replicate(_inc(spark, d).select("key", "category"), 3).drop("copy")


@register("drop_nulls_subset", W(o.INCIDENTS_RAW) + """
SELECT key, category, lat_raw, day_raw FROM incidents_raw WHERE lat_raw IS NOT NULL AND NOT isnan(lat_raw)
  AND day_raw IS NOT NULL""")
def q_drop_nulls_subset(spark, d):
    raw = fxt.incidents_raw(spark, d).select("key", "category", "lat_raw", "day_raw")
    return clean.drop_nulls(raw, ["lat_raw", "day_raw"])


@register("density_points", W(o.INCIDENTS) + "SELECT lat, lon, 1 AS weight FROM incidents")
def q_density_points(spark, d):
    return filters.with_weight(_inc(spark, d).select("lat", "lon"))


@register("parts_sold_share", f"""
WITH s AS (SELECT p_brand AS category FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT category, count(*) AS n, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, {R}) AS share
FROM s GROUP BY category""")
def q_parts_sold_share(spark, d):
    return agg.share_of_counts(fxt.parts_sold(spark, d)).withColumn("share", rnd("share"))


@register("summary_export", _dense_sql("true") + """
, tot AS (SELECT count(*) AS total, count(DISTINCT category) AS nd FROM f)
SELECT 'Total Crimes' AS metric, total AS value FROM tot
UNION ALL SELECT 'Unique Crime Types', nd FROM tot WHERE total > 0
UNION ALL SELECT 'Peak Crime Hour', CAST(peak_hour AS BIGINT) FROM pk, tot WHERE total > 0
UNION ALL SELECT 'Least Crime Hour', CAST(least_hour AS BIGINT) FROM lt, tot WHERE total > 0""")
def q_summary_export(spark, d):
    import uuid

    from ..session import scratch_path
    from ..sources import files

    out = scratch_path(spark, f"summary-{uuid.uuid4().hex}")
    files.write_summary(agg.summary_stats(_inc(spark, d), "category", "hour"), out)
    return files.read_raw_csv(spark, out, "metric string, value long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import jobs  # noqa: F401  (registers the composite jobs)

    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    from . import jobs  # noqa: F401

    return dict(SQL)
