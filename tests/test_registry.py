"""Every registered query runs; SQL-twinned ones match DuckDB at sf0.001."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from placetime.plans import oracle_sql as registered_sql
from placetime.plans import queries as registered

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events labels".split()
MODEL_QUERIES = {"rf_train_score", "feature_importance", "scenario_scores", "scenario_top10",
                 "train_status"}


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 and df.columns == ["hour", "n", "rolling_avg"]


def test_registry_has_sql_for_all_but_models():
    q, s = registered(), registered_sql()
    assert set(s) <= set(q)
    assert set(q) - set(s) == MODEL_QUERIES


SQL_NAMES = sorted(registered_sql())


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = duck.sql(entry.oracle_sql()[name])
    dcols = rel.columns
    assert sorted(dcols) == cols
    drows = sorted((tuple(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall()), key=_key)
    assert rows == drows
