"""Adapter views that present the driver's test tables as incident tables.

``events`` becomes an incident table: key ``event_id``, category
``event_type`` (or the JSON field ``props.k`` for a 100-category variant),
hour and weekday from ``ts``, and keyed coordinates in the reference's box.
Each view is a lazy projection over the parquet scan, so column pruning and
predicate pushdown reach the files.  The SQL twins live in
``placetime.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import keyed_int, keyed_range, keyed_uniform
from ..roles import DAY_NAMES, LAT_LOW, LAT_WIDTH, LON_LOW, LON_WIDTH, ColumnRoles

INCIDENT_ROLES = ColumnRoles(category="category", lat="lat", lon="lon", hour="hour", day="day", key="key")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weekday_name(ts: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(ts) + F.lit(1))


def _coords(key: str) -> list:
    return [
        keyed_range("lat", LAT_LOW, LAT_WIDTH, key).alias("lat"),
        keyed_range("lon", LON_LOW, LON_WIDTH, key).alias("lon"),
    ]


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, category (5 event types), hour, day, lat, lon."""
    return incidents_of(table(spark, sf_dir, "events"))


def incidents_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("key"),
        F.col("event_type").alias("category"),
        F.hour("ts").cast("int").alias("hour"),
        weekday_name("ts").alias("day"),
        *_coords("event_id"),
    )


def incidents_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``incidents`` with category = ``props.k`` (100 values)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("key"),
        F.get_json_object("props", "$.k").alias("category"),
        F.hour("ts").cast("int").alias("hour"),
        weekday_name("ts").alias("day"),
        *_coords("event_id"),
    )


def incidents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty variant for the cleaning operators.

    ``hour_raw = value/4 - 2`` needs truncation and clipping at both ends;
    ``lat_raw`` is missing for about 5% of keys; ``day_raw`` holds one of six
    spellings per key (full, 3-letter lower, upper, padded 4-letter, null,
    unknown), so normalisation, imputation and modes all have work to do.
    """
    ev = table(spark, sf_dir, "events")
    day = weekday_name("ts")
    form = keyed_int("dayform", 6, "event_id")
    day_raw = (
        F.when(form == 0, day)
        .when(form == 1, F.lower(F.substring(day, 1, 3)))
        .when(form == 2, F.upper(day))
        .when(form == 3, F.concat(F.lit(" "), F.substring(day, 1, 4), F.lit(" ")))
        .when(form == 5, F.concat(F.lit("x"), F.lower(day)))
    )
    lat = keyed_range("lat", LAT_LOW, LAT_WIDTH, "event_id")
    return ev.select(
        F.col("event_id").alias("key"),
        F.col("event_type").alias("category"),
        (F.col("value") / F.lit(4.0) - F.lit(2.0)).alias("hour_raw"),
        F.when(keyed_uniform("latna", "event_id") >= F.lit(0.05), lat).alias("lat_raw"),
        keyed_range("lon", LON_LOW, LON_WIDTH, "event_id").alias("lon"),
        day_raw.alias("day_raw"),
    )


def incidents_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region: key, category, region, nation, hour, lat, lon.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables, so
    they are broadcast; orders ⋈ customer is left to the planner (both grow).
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return j.select(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderpriority").alias("category"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("nation"),
        keyed_int("hour", 24, "o_orderkey").alias("hour"),
        *_coords("o_orderkey"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def parts_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category, n): sold lines per brand.  Lines are counted per part before
    the join, so a part that is sold very often is one row in it."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sold = li.join(p, li.l_partkey == p.p_partkey)
    return sold.groupBy(F.col("p_brand").alias("category")).agg(F.sum("lines").alias("n"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as a (label, prediction) table: quality vs toxic."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("key"),
        F.col("quality").cast("string").alias("label"),
        F.col("toxic").cast("string").alias("prediction"),
    )
