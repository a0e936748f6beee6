"""Bag replication: every row n times, with fresh keyed draws per copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed_int, keyed_range
from ..roles import LAT_LOW, LAT_WIDTH, LON_LOW, LON_WIDTH, ColumnRoles


def replicate(df: DataFrame, n: int = 3, copy: str = "copy") -> DataFrame:
    """n copies of each row in one scan (``explode(sequence(1, n))``), instead
    of a union that scans the input n times.  (key, copy) is the new key."""
    return df.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(int(n)))))


def simulate_place_time(df: DataFrame, roles: ColumnRoles, copy: str | None = "copy") -> DataFrame:
    """Draw latitude, longitude and hour per (key[, copy]) in the reference box.

    Keyed draws instead of ``rand()``: stable under re-execution and
    partitioning, and each copy of a row gets its own values.
    """
    keys = [roles.key] + ([copy] if copy and copy in df.columns else [])
    return df.withColumns({
        roles.lat: keyed_range("lat", LAT_LOW, LAT_WIDTH, *keys),
        roles.lon: keyed_range("lon", LON_LOW, LON_WIDTH, *keys),
        roles.hour: keyed_int("hour", 24, *keys),
    })
