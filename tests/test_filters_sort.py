"""Filters, projections, sorts and positions."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from placetime.operators import filters, joins, sort
from placetime.roles import SORT_CATEGORY, SORT_FREQUENCY, SORT_HOUR_ASC, SORT_HOUR_DESC, ColumnRoles, FilterSpec

ROLES = ColumnRoles()


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, category string, lat double, lon double, hour int")


@pytest.fixture()
def small(spark):
    cats = ["Theft", "theft", "Assault", "Burglary", "a(b"]
    return frame(spark, [(i, cats[i % 5], 28.5, 77.2, (i * 7) % 24) for i in range(100)])


def test_category_filter_empty_none_and_list(small):
    assert filters.category_filter(small, "category", []).count() == 0
    assert filters.category_filter(small, "category", None).count() == 100
    assert filters.category_filter(small, "category", ["Theft"]).count() == 20


def test_category_filter_large_list_uses_semi_join(spark, small):
    values = ["Theft"] + [f"x{i}" for i in range(2000)]
    out = filters.category_filter(small, "category", values)
    assert out.count() == 20


def test_search_is_case_insensitive_regex(small):
    assert filters.category_search(small, "category", "  THEFT ").count() == 40
    assert filters.category_search(small, "category", "^a").count() == 40  # Assault, a(b
    assert filters.category_search(small, "category", "   ").count() == 100


def test_bad_pattern_rejected_and_literal_ok(small):
    with pytest.raises(ValueError):
        filters.category_search(small, "category", "a(b")
    assert filters.category_search(small, "category", "a(b", literal=True).count() == 20


def test_place_filter_case(spark):
    df = spark.createDataFrame([("New Delhi",), ("delhi",), (None,), ("Mumbai",)], "city string")
    assert filters.place_filter(df, "city", "Delhi").count() == 1
    assert filters.place_filter(df, "city", "Delhi", case_sensitive=False).count() == 2


def test_first_string_match(spark):
    df = spark.createDataFrame([("a", "Delhi", "x"), ("b", "Pune", "Delhi")], "k string, s1 string, s2 string")
    out, col = filters.first_string_match(df, "Delhi")
    assert col == "s1" and out.count() == 1
    out, col = filters.first_string_match(df, "Nowhere")
    assert col is None and out.count() == 2


def test_apply_filters_chain(small):
    spec = FilterSpec(categories=("Theft", "theft", "Assault"), hour_range=(5, 20), search="the")
    out = filters.apply_filters(small, ROLES, spec)
    rows = out.collect()
    assert rows and all(r["category"] in ("Theft", "theft") and 5 <= r["hour"] <= 20 for r in rows)


def _brute(df, order):
    return {r["key"]: r["p"] for r in df.withColumn("p", F.row_number().over(Window.orderBy(*order))).collect()}


@pytest.mark.parametrize("mode", [SORT_HOUR_ASC, SORT_HOUR_DESC, SORT_CATEGORY, SORT_FREQUENCY])
def test_sorted_positions_match_row_number(spark, small, mode):
    skewed = small.unionByName(frame(spark, [(1000 + i, "Theft", 28.5, 77.2, 3) for i in range(300)]))
    for parts in (1, 7):
        data = skewed.repartition(parts)
        got = {r["key"]: r["pos"] for r in sort.sorted_with_position(data, ROLES, mode).collect()}
        src = sort.category_frequency(data, "category") if mode == SORT_FREQUENCY else data
        want = _brute(src, sort.order_columns(sort.sort_order(ROLES, mode)))
        assert got == want


def test_preview_limits_and_projects(small):
    out = sort.preview(small, ROLES, 10, ["key", "hour"])
    rows = out.orderBy("pos").collect()
    assert len(rows) == 10 and out.columns == ["key", "hour", "pos"]
    assert [r["hour"] for r in rows] == sorted(r["hour"] for r in rows)


def test_empty_frames(spark):
    empty = frame(spark, [])
    assert sort.sorted_with_position(empty, ROLES, SORT_HOUR_ASC).count() == 0
    assert filters.apply_filters(empty, ROLES, FilterSpec()).count() == 0


def test_category_filter_with_frame(spark, small):
    sel = spark.createDataFrame([("Theft",), ("Theft",), ("nope",)], "c string")
    assert filters.category_filter(small, "category", sel).count() == 20


def _folder_entries(spark):
    return sum(len(files) for _, _, files in os.walk(spark.sparkContext.getCheckpointDir().removeprefix("file:")))


def test_positions_over_many_ranges_without_files(spark, monkeypatch):
    monkeypatch.setattr(sort, "LEAST_RANGE_ROWS", 10)
    rows = [(i, "hot" if i % 10 else f"c{i % 7}", i % 3 / 2, None if i % 11 == 0 else i % 5) for i in range(4000)]
    df = spark.createDataFrame(rows, "key long, category string, x double, hour int")
    orders = [[("hour", True), ("category", True), ("key", True)], [("category", False), ("hour", False), ("key", False)],
              [("x", False), ("category", True), ("key", True)], [("category", True), ("key", True)]]
    before = _folder_entries(spark)
    for order in orders:
        want = _brute(df, sort.order_columns(order))
        for parts in (1, 9):
            out = sort.number_rows(df.repartition(parts), order, ranges=12).withColumn("task", F.spark_partition_id()).collect()
            assert {r["key"]: r["pos"] for r in out} == want
            # A range is a task of its own, the hot category is spread over many, and tasks come in the order.
            sizes, first = {}, {}
            for r in out:
                sizes[r["task"]] = sizes.get(r["task"], 0) + 1
                first[r["task"]] = min(first.get(r["task"], r["pos"]), r["pos"])
            assert len(sizes) == 12 and max(sizes.values()) < 2 * 4000 / 12
            assert [first[t] for t in sorted(first)] == sorted(first.values())
    by_frequency = sort.sorted_with_position(df.select("key", "category", "hour"), ROLES, SORT_FREQUENCY)
    assert by_frequency.count() == 4000 and _folder_entries(spark) == before


def test_positions_plan_has_one_exchange_of_rows(spark):
    df = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 7).cast("string").alias("category"), (F.col("id") % 24).cast("int").alias("hour"))
    plan = sort.sorted_with_position(df, ROLES, SORT_CATEGORY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "shufflepartitionidpassthrough" in plan


def test_large_lookup_stays_a_join(spark):
    big = spark.range(100).select((F.col("id") % 10).alias("c"))
    sizes = big.groupBy("c").count()
    got = joins.join_bounded(big, sizes, "c", max_rows=3)
    assert got.where("count = 10").count() == 100 and joins.join_bounded(big, sizes, "c").where("count = 10").count() == 100
