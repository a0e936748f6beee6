"""Shared tables, mergeable distinct sketches, the class grid without one task, the report's reads."""

from pyspark.sql import functions as F

from placetime.operators import metrics, sketch
from placetime.plans import queries
from placetime.sources.shared import open_tables, shared_table

from .conftest import SF_SMALL


def cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_shared_table_persists_from_the_second_reader_on(spark, scratch):
    path = scratch + "/t"
    spark.range(50).withColumn("v", F.col("id") * 2).write.parquet(path)
    before = cached(spark)
    with shared_table(spark, path, columns=["id"]) as a:
        assert a.columns == ["id"] and a.count() == 50 and cached(spark) == before and open_tables() == 1
        with shared_table(spark, path, columns=["id"]) as b, shared_table(spark, path) as other:
            assert b is a and other is not a and open_tables() == 2
            assert b.count() == 50 and cached(spark) == before + 1
            assert "InMemoryTableScan" in a.select("id").where("id > 3")._jdf.queryExecution().executedPlan().toString()
        assert cached(spark) == before + 1  # a reader is left
    assert cached(spark) == before and open_tables() == 0
    try:
        with shared_table(spark, path), shared_table(spark, path) as b:
            b.count()
            raise ValueError("a failing job")
    except ValueError:
        pass
    assert cached(spark) == before and open_tables() == 0


def test_report_job_leaves_no_cached_block(spark):
    before = cached(spark)
    assert queries()["report_job"](spark, SF_SMALL).where("part = 'input'").first()["value"] == 1000
    assert cached(spark) == before and open_tables() == 0


def test_sketches_unite_and_estimate(spark):
    df = spark.range(30_000).select((F.col("id") % 9000).alias("v"), (F.col("id") % 7).alias("part"))
    parts = sketch.distinct_sketch(df, "v", ["part"])
    whole = sketch.distinct_sketch(df.repartition(5), "v")
    key = lambda rows: sorted((r["register"], r["rank"]) for r in rows.collect())
    assert key(sketch.merge_sketches(parts)) == key(whole)
    assert abs(sketch.sketch_estimate(whole).first()["estimate"] - 9000) < 4 * sketch.STANDARD_ERROR * 9000
    each = {r["part"]: r["estimate"] for r in sketch.sketch_estimate(parts, ["part"]).collect()}
    exact = {r["part"]: r["n"] for r in df.groupBy("part").agg(F.count_distinct("v").alias("n")).collect()}
    assert all(abs(each[p] - n) < 4 * sketch.STANDARD_ERROR * n for p, n in exact.items())
    none = df.limit(0)
    assert sketch.sketch_estimate(sketch.distinct_sketch(none, "v")).first()["estimate"] == 0
    nulls = spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "v string")
    assert round(sketch.sketch_estimate(sketch.distinct_sketch(nulls, "v")).first()["estimate"]) == 2


def test_class_grid_of_many_classes(spark):
    df = spark.range(3000).select(F.format_string("c%04d", F.col("id") % 60).alias("label"), F.format_string("c%04d", (F.col("id") * 7) % 50).alias("prediction"))
    cm = metrics.confusion_matrix(df)
    assert cm.count() == 3600 and cm.agg(F.sum("n")).first()[0] == 3000 and cm.dropDuplicates(["actual", "predicted"]).count() == 3600
    plan = cm._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
    report = metrics.classification_report(df).orderBy("pos").collect()
    assert [r["pos"] for r in report] == list(range(1, 64)) and report[0]["label"] == "c0000" and report[-1]["label"] == "weighted avg"
    some = metrics.confusion_matrix(df, classes=["c0001", "c0002", "zz"])
    assert some.count() == 9 and some.where("actual = 'zz'").agg(F.sum("n")).first()[0] == 0
    part = {r["label"]: r for r in metrics.classification_report(df, classes=["c0001", "zz"]).collect()}
    assert part["zz"]["support"] == 0 and part["macro avg"]["support"] == part["c0001"]["support"]
    assert metrics.confusion_matrix(df.limit(0)).count() == 0
