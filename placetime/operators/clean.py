"""Cleaning and enrichment: null drops, numeric coercion, hour clipping, and
the derived time band, cyclic hour and day-of-week columns.

All narrow projections: no shuffle, one pass, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import (
    clip_hour,
    hour_cos,
    hour_sin,
    in_domain,
    is_number,
    keyed_day,
    normalize_day,
    time_band,
)
from ..roles import DAY_COLUMN_ALIASES, DAY_NAMES, MISSING_CATEGORY, TIME_BANDS, ColumnRoles
from ..sources.schema import aliased_column


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.na.drop(how="any")


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN) in one of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def coerce_incidents(df: DataFrame, roles: ColumnRoles, missing: str | None = MISSING_CATEGORY) -> DataFrame:
    """Category as string, coordinates and hour as numbers (bad -> null),
    rows missing a number dropped, hour truncated and clipped to 0..23.

    A missing category is kept as the text ``missing``, by default what the text
    of a field missing from a CSV file is; ``missing=None`` drops the row.
    Deviation: +-infinity is dropped instead of failing.
    """
    c, la, lo, h = roles.category, roles.lat, roles.lon, roles.hour
    # Validate the raw values first, then convert: each input is read once
    # by the filter and once by the projection (a filter on the converted
    # columns would be pushed below the projection with every conversion
    # inlined into it).
    valid = is_number(la) & is_number(lo) & is_number(h)
    text = F.col(c).cast("string")
    if missing is None:
        valid = F.col(c).isNotNull() & valid
    else:
        text = F.coalesce(text, F.lit(missing))
    return df.where(valid).withColumns({
        c: text,
        la: F.col(la).try_cast("double"),
        lo: F.col(lo).try_cast("double"),
        h: clip_hour(F.col(h).try_cast("double")),
    })


def day_column(df: DataFrame, roles: ColumnRoles) -> str | None:
    if roles.day and roles.day in df.columns:
        return roles.day
    return aliased_column(df.columns, DAY_COLUMN_ALIASES)


def complete_day(df: DataFrame, roles: ColumnRoles, day_seed: str = "day", out: str = "day") -> DataFrame:
    """A day name for every row: the normalised day column when one exists
    and is readable, otherwise a keyed draw from the seven names.

    Deviation: the draw is keyed by the row key, so a row keeps its day
    under any filter (the original seeded by the filtered frame's content).
    """
    src = day_column(df, roles)
    drawn = keyed_day(day_seed, roles.key)
    day = F.coalesce(normalize_day(src), drawn) if src else drawn
    return df.withColumn(out, in_domain(day, DAY_NAMES))


def enrich(df: DataFrame, roles: ColumnRoles, day_seed: str = "day", out_day: str = "day") -> DataFrame:
    """Add ``time_band``, ``hour_sin``, ``hour_cos`` and a complete day."""
    h = F.col(roles.hour)
    out = df.withColumns({
        "time_band": in_domain(time_band(h), TIME_BANDS),
        "hour_sin": hour_sin(h),
        "hour_cos": hour_cos(h),
    })
    return complete_day(out, roles, day_seed, out_day)


def prepare_base(df: DataFrame, roles: ColumnRoles, day_seed: str = "day") -> DataFrame:
    """coerce + enrich: the cleaned, enriched frame every analysis starts from."""
    return enrich(coerce_incidents(df, roles), roles, day_seed)
