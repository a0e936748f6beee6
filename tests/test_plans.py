"""Physical-plan checks: no Python evaluation, pushdown, pruning, one scan."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

CHEAP = ["hourly_trend", "clean_rows", "enrich_rows", "category_share", "pivot_wide", "density_grid",
         "corr_matrix", "nearest_center", "scenario_features", "stratified_split", "summary_stats",
         "heatmap_normalized", "classification_report", "replicate3", "place_filter"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_in_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_place_predicate_reaches_scan(spark):
    plan = _plan(entry.queries()["place_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(n_name), StringContains(n_name,NATION_1)" in plan


def test_hourly_counts_read_only_timestamp(spark):
    plan = _plan(entry.queries()["hourly_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_summary_and_heatmap_scan_events_once(spark):
    for name in ("summary_stats", "heatmap_normalized", "category_share"):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert plan.count("FileScan parquet") <= 1, name


def test_scenario_scoring_has_no_key_shuffle(spark):
    from placetime.operators import clean, ml, predict, spatial
    from placetime.roles import ColumnRoles
    from placetime.sources import fixtures

    roles = ColumnRoles(day="day")
    base = clean.prepare_base(fixtures.incidents(spark, SF_SMALL), roles)
    centers = [(28.5, 77.1), (28.8, 77.4)]
    res = ml.train_classifier(spatial.assign_centers(base, "lat", "lon", centers), "category", "key",
                              ml.ForestPreset(num_trees=3, max_depth=3))
    pts = predict.scenario_features(fixtures.incidents(spark, SF_SMALL).select("key", "hour", "lat", "lon"),
                                    centers=centers)
    best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key")
    for df in (best, ranked):
        plan = _plan(df)
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
