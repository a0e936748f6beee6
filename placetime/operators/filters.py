"""Row filters: place, category list, hour range, category search, first
matching string column, projection, and the composed dashboard filter chain.

Filters are predicates on raw columns, so Catalyst pushes them to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..roles import ColumnRoles, FilterSpec
from ..sources.schema import string_columns
from .clean import coerce_incidents


def validate_pattern(pattern: str) -> str:
    """Reject a malformed regular expression before a job fails on it."""
    session = SparkSession.getActiveSession()
    try:
        if session is None:
            re.compile(pattern)
        else:  # the dialect of the executors
            session._jvm.java.util.regex.Pattern.compile(pattern)
    except (re.error, IllegalArgumentException) as exc:
        raise ValueError(f"Invalid search pattern {pattern!r}: {exc}") from exc
    return pattern


def text_match(c: Column, term: str, case_sensitive: bool = True, regex: bool = False) -> Column:
    """Literal ``contains`` or a (case-insensitive) regex; null for null input.

    Used bare in filters (a null row is dropped either way), so literal
    matches reach the parquet reader as pushed ``StringContains`` filters.
    """
    if regex:
        pat = validate_pattern(term)
        m = c.rlike(pat if case_sensitive else f"(?i){pat}")
    elif case_sensitive:
        m = c.contains(term)
    else:
        m = F.lower(c).contains(term.lower())
    return m


def place_filter(df: DataFrame, column: str, term: str, case_sensitive: bool = True,
                 regex: bool = False) -> DataFrame:
    """Keep rows whose place column (read as text) matches ``term``.

    The batch job matched literally and case-sensitively; its single-machine
    twin matched a case-insensitive pattern.  Both are options here.
    """
    return df.where(text_match(F.col(column).cast("string"), term, case_sensitive, regex))


def first_string_match(df: DataFrame, term: str, case_sensitive: bool = True,
                       regex: bool = False) -> tuple[DataFrame, str | None]:
    """Filter on the first string column (schema order) that has a match.

    One aggregate pass computes ``max(match)`` for every string column at
    once (the original issued a job per column); if no column matches, all
    rows are kept.  Returns the filtered frame and the chosen column.
    """
    cols = string_columns(df)
    if not cols:
        return df, None
    probes = [F.max(F.coalesce(text_match(F.col(c), term, case_sensitive, regex), F.lit(False)).cast("int")).alias(c)
              for c in cols]
    hit = df.select(*probes).first()
    for c in cols:
        if hit is not None and hit[c] == 1:
            return df.where(text_match(F.col(c), term, case_sensitive, regex)), c
    return df, None


def category_filter(df: DataFrame, column: str, selected: Sequence[str] | DataFrame | None) -> DataFrame:
    """Multi-select: keep listed categories; an empty selection keeps none.

    ``None`` keeps everything.  A list is a set lookup in the filter,
    whatever its length; a DataFrame of values is a left-semi join.
    """
    if selected is None:
        return df
    if isinstance(selected, DataFrame):
        from .joins import join_small

        vals = selected.select(F.col(selected.columns[0]).alias(column)).distinct()
        return join_small(df, vals, column, "left_semi")
    values = list(selected)
    if not values:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(values))


def hour_range(df: DataFrame, column: str, lo: int, hi: int) -> DataFrame:
    """Inclusive hour range."""
    return df.where(F.col(column).between(int(lo), int(hi)))


def category_search(df: DataFrame, column: str, text: str, literal: bool = False) -> DataFrame:
    """Case-insensitive search of the category; blank text is no filter.

    By default ``text`` is a regular expression (as in pandas
    ``str.contains``); ``literal=True`` matches plain text.
    """
    t = (text or "").strip()
    if not t:
        return df
    return df.where(text_match(F.col(column), t, case_sensitive=False, regex=not literal))


def project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Column projection; an empty list means all columns."""
    return df.select(*columns) if columns else df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def with_weight(df: DataFrame, name: str = "weight") -> DataFrame:
    """Constant weight column (density layers weight every point by 1)."""
    return df.withColumn(name, F.lit(1))


def apply_filters(df: DataFrame, roles: ColumnRoles, spec: FilterSpec) -> DataFrame:
    """coerce -> drop -> clip -> categories -> hours -> search (lazy).

    Sorting is separate (``placetime.operators.sort``): a sort only matters
    for an ordered output, and the last sort decides the order anyway.
    """
    out = coerce_incidents(df, roles)
    out = category_filter(out, roles.category, spec.categories)
    out = hour_range(out, roles.hour, *spec.hour_range)
    out = category_search(out, roles.category, spec.search, spec.literal)
    return out
