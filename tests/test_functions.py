"""Literal edge fixtures for the column functions and cleaning."""

import math

from pyspark.sql import functions as F

from placetime.functions import (
    hour_intensity,
    keyed_int,
    keyed_uniform,
    normalize_day,
    pair_label,
    time_band,
    time_code,
    day_code,
)
from placetime.functions import hashing
from placetime.operators import clean
from placetime.roles import ColumnRoles


def test_hour_coercion_and_clipping(spark):
    raw = ["-5", "-0.7", "23.9", "24", "7", "abc", "nan", None, "inf", "Infinity", " 7 "]
    df = spark.createDataFrame([(i, "a", "28.5", "77.2", h) for i, h in enumerate(raw)],
                               "key long, category string, lat string, lon string, hour string")
    roles = ColumnRoles()
    out = {r["key"]: r["hour"] for r in clean.coerce_incidents(df, roles).collect()}
    # -5 -> 0, -0.7 -> 0, 23.9 -> 23, 24 -> 23, '7' -> 7; bad, NaN, null, inf dropped
    assert out == {0: 0, 1: 0, 2: 23, 3: 23, 4: 7, 10: 7}


def test_numeric_coercion_of_coordinates(spark):
    df = spark.createDataFrame([(1, "a", "x", 77.0, 3.0), (2, "a", "28.5", None, 3.0), (3, None, "28.5", 77.0, 3.0),
                                (4, "a", "28.5", 77.0, 3.0)],
                               "key long, category string, lat string, lon double, hour double")
    out = clean.coerce_incidents(df, ColumnRoles()).collect()
    # A row without a number goes; one without a category stays with the text of a missing CSV field.
    assert [(r["key"], r["category"]) for r in out] == [(3, "nan"), (4, "a")]
    assert out[1]["lat"] == 28.5 and out[1]["hour"] == 3


def test_day_normalisation(spark):
    vals = [" Tues ", "MON", "Friday", "funday", None, "thurs", "weds", "SUN"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r[0] for r in df.select(normalize_day("d")).collect()]
    assert got == ["Tuesday", "Monday", "Friday", None, None, "Thursday", "Wednesday", "Sunday"]


def test_time_bands_and_intensity(spark):
    hours = [4, 5, 11, 12, 16, 17, 20, 21, 0, 8, 9, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    rows = df.select("h", time_band("h").alias("b"), hour_intensity("h").alias("i")).collect()
    bands = {r["h"]: r["b"] for r in rows}
    assert bands[4] == "Night" and bands[5] == "Morning" and bands[11] == "Morning"
    assert bands[12] == "Afternoon" and bands[16] == "Afternoon" and bands[17] == "Evening"
    assert bands[20] == "Evening" and bands[21] == "Night"
    inten = {r["h"]: r["i"] for r in rows}
    assert inten[0] == "Low" and inten[8] == "Low" and inten[9] == "Medium"
    assert inten[16] == "Medium" and inten[17] == "High" and inten[23] == "High"
    out = spark.createDataFrame([(-1,), (24,)], "h int").select(hour_intensity("h")).collect()
    assert [r[0] for r in out] == [None, None]


def test_codes(spark):
    df = spark.createDataFrame([("Monday", "Night"), ("Sunday", "Evening"), ("Nope", "Dusk")], "d string, b string")
    got = df.select(day_code("d"), time_code("b")).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (6.0, 3.0), (None, None)]


def test_pair_label(spark):
    df = spark.createDataFrame([("Hour", "Latitude")], "a string, b string")
    assert df.select(pair_label("a", "b")).first()[0] == "Hour vs Latitude"


def test_keyed_draws_are_partition_invariant(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "key")
    draws = df.select("key", keyed_uniform("s", "key").alias("u"), keyed_int("s", 24, "key").alias("h"))
    a = sorted(draws.repartition(1).collect())
    b = sorted(draws.repartition(16).collect())
    assert a == b
    us = [r["u"] for r in a]
    assert all(0.0 <= u < 1.0 for u in us)
    assert abs(sum(us) / len(us) - 0.5) < 0.05
    assert set(r["h"] for r in a) == set(range(24))


def test_keyed_uniform_matches_md5_definition(spark):
    import hashlib

    df = spark.createDataFrame([(7,), (123456789,)], "key long")
    got = [r[0] for r in df.select(keyed_uniform("lat", "key")).collect()]
    want = [int(hashlib.md5(f"lat|{k}".encode()).hexdigest()[:8], 16) / 2 ** 32 for k in (7, 123456789)]
    assert all(math.isclose(g, w, rel_tol=0, abs_tol=0) for g, w in zip(got, want))


def test_enrich_without_day_column_is_filter_stable(spark):
    df = spark.createDataFrame([(i, "a", 28.5, 77.2, i % 24) for i in range(200)],
                               "key long, category string, lat double, lon double, hour int")
    roles = ColumnRoles()
    full = {r["key"]: r["day"] for r in clean.enrich(df, roles).collect()}
    part = {r["key"]: r["day"] for r in clean.enrich(df.where(F.col("key") < 50), roles).collect()}
    assert all(full[k] == v for k, v in part.items())
    assert set(full.values()) <= {"Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"}


def test_keyed_digests_are_those_of_the_columns(spark):
    keys = [None, *map(str, range(300)), "", "é" * 20, *("k" * n for n in range(40, 130, 3))]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string")
    for seed in ("bag42-7", "bag42-17"):
        draws = [F.expr(hashing.keyed_uniform_sql(seed, "key", word)) for word in range(4)]
        want = [list(r) for r in rows.orderBy("i").select(*draws).collect()]
        own = hashing.KeyedDigests([b"" if k is None else b"|" + k.encode() for k in keys]).of(seed.encode()).T / 2**32
        assert own.tolist() == want
