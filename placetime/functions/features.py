"""Column expressions for cleaning and feature derivation.

All are built-in Spark expressions (whole-stage codegen, no Python UDF).
Spark 4 runs with ANSI mode on, so coercions use ``try_cast`` and lookups
``try_element_at``: a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..roles import (
    AFTERNOON_START,
    DAY_ALIASES,
    DAY_NAMES,
    EVENING_START,
    INTENSITY_EDGES,
    INTENSITY_LABELS,
    MORNING_START,
    NIGHT_START,
    TIME_BANDS,
)
from .hashing import keyed_choice


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    """A map literal; lookups against it stay inside the generated code."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def is_number(c: str | Column) -> Column:
    """True when ``c`` coerces to a finite number (false for null, text, NaN)."""
    return F.coalesce(F.abs(_as_col(c).try_cast("double")) < F.lit(float("inf")), F.lit(False))


def clip_hour(c: str | Column) -> Column:
    """Truncate toward zero and clip to 0..23 (clip first: no ANSI overflow)."""
    return F.least(F.greatest(_as_col(c), F.lit(0.0)), F.lit(23.0)).cast("int")


def time_band(hour: str | Column) -> Column:
    h = _as_col(hour)
    return (
        F.when((h >= MORNING_START) & (h < AFTERNOON_START), F.lit(TIME_BANDS[1]))
        .when((h >= AFTERNOON_START) & (h < EVENING_START), F.lit(TIME_BANDS[2]))
        .when((h >= EVENING_START) & (h < NIGHT_START), F.lit(TIME_BANDS[3]))
        .otherwise(F.lit(TIME_BANDS[0]))
    )


def hour_angle(hour: str | Column) -> Column:
    return F.lit(2 * math.pi) * _as_col(hour) / F.lit(24.0)


def hour_sin(hour: str | Column) -> Column:
    return F.sin(hour_angle(hour))


def hour_cos(hour: str | Column) -> Column:
    return F.cos(hour_angle(hour))


def normalize_day(c: str | Column) -> Column:
    """Trim + lower-case, then map one of 18 spellings to a day name; else null."""
    return F.try_element_at(literal_map(DAY_ALIASES), F.lower(F.trim(_as_col(c).cast("string"))))


def keyed_day(seed: str, *keys: str | Column) -> Column:
    """A day name drawn uniformly by key (stable under filters)."""
    return keyed_choice(seed, DAY_NAMES, *keys)


def in_domain(c: str | Column, domain) -> Column:
    """Value if it belongs to the fixed domain, else null (pandas Categorical)."""
    col = _as_col(c)
    return F.when(col.isin(list(domain)), col)


def ordinal_code(c: str | Column, domain) -> Column:
    """Position in the domain as a double (Monday = 0, Night = 0); else null."""
    return F.try_element_at(literal_map({v: float(i) for i, v in enumerate(domain)}), _as_col(c))


def day_code(c: str | Column) -> Column:
    return ordinal_code(c, DAY_NAMES)


def time_code(c: str | Column) -> Column:
    return ordinal_code(c, TIME_BANDS)


def hour_intensity(hour: str | Column) -> Column:
    """Right-closed bins (-1, 8], (8, 16], (16, 23]; outside is null."""
    h = _as_col(hour)
    lo, b1, b2, hi = INTENSITY_EDGES
    return (
        F.when((h > lo) & (h <= b1), F.lit(INTENSITY_LABELS[0]))
        .when((h > b1) & (h <= b2), F.lit(INTENSITY_LABELS[1]))
        .when((h > b2) & (h <= hi), F.lit(INTENSITY_LABELS[2]))
    )


def pair_label(a: str | Column, b: str | Column) -> Column:
    return F.concat_ws(" vs ", _as_col(a), _as_col(b))
