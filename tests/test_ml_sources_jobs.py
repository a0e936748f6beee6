"""Classifier gates and invariants, scenario scoring, sources, sinks, jobs,
streaming."""

import os

import pytest
from pyspark.sql import functions as F

from placetime.operators import clean, ml, predict, replicate, spatial
from placetime.plans import jobs
from placetime.roles import ColumnRoles
from placetime.sources import files, fixtures, schema
from placetime.streaming import hourly_counts_stream

from .conftest import SF_SMALL

ROLES = ColumnRoles(day="day")


@pytest.fixture(scope="module")
def trained(spark):
    base = clean.prepare_base(fixtures.incidents(spark, SF_SMALL), ROLES)
    data = spatial.assign_centers(base, "lat", "lon", [(28.5, 77.1), (28.8, 77.4)])
    return data, ml.train_classifier(data, "category", "key", "small")


def test_training_gates(spark):
    one = spark.createDataFrame([(i, "a", 28.5, 77.1, 3, 0.1, 0.9, "Night", "Monday", "0") for i in range(30)],
                                "key long, category string, lat double, lon double, hour int, hour_sin double, "
                                "hour_cos double, time_band string, day string, cluster_id string")
    res = ml.train_classifier(one, "category", "key")
    assert not res.ready and res.prior.count() == 1
    few = one.limit(10).withColumn("category", F.when(F.col("key") < 5, "a").otherwise("b"))
    assert not ml.train_classifier(few, "category", "key").ready
    empty = ml.train_classifier(one.limit(0), "category", "key")
    assert not empty.ready and empty.prior is None


def test_forest_invariants(spark, trained):
    data, res = trained
    assert res.ready and res.classes == sorted(res.classes)
    preds = res.predictions.collect()
    assert preds and all(p["prediction"] in res.classes for p in preds)
    imp = ml.feature_importance(spark, res).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    assert {r["feature"] for r in imp} <= set(ml.NUMERIC_FEATURES) | set(ml.CATEGORICAL_FEATURES)
    pts = predict.scenario_features(data.select("key", "hour", "lat", "lon").limit(50),
                                    centers=[(28.5, 77.1), (28.8, 77.4)])
    best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key")
    sums = ranked.groupBy("key").agg(F.sum("probability").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in sums)
    top = ranked.where("rank = 1").select("key", F.col("class").alias("c"))
    joined = best.join(top, "key").collect()
    assert joined and all(r["prediction"] == r["c"] for r in joined)


def test_scenarios_are_scored_in_blocks_as_the_native_forest_scores_rows(spark, trained):
    """One task's points are dealt over the tasks, only asked ranks leave a block, and sums are the native forest's own."""
    from pyspark.ml.functions import vector_to_array

    data, res = trained
    pts = predict.scenario_features(data.select("key", "hour", "lat", "lon").limit(60).coalesce(1), centers=[(28.5, 77.1), (28.8, 77.4)])
    for weights in (None, {"Monday": 3.0, "Friday": 1.0}):
        rows = predict.expand_days(pts, weights)
        for stage in res.model.stages[1:]:
            rows = stage.transform(rows)
        native = {(r["key"], r["day"]): (r["day_weight"], r["p"]) for r in rows.select("key", "day", "day_weight", vector_to_array("probability").alias("p")).collect()}
        expected = {}
        for key in {k for k, _ in native}:
            mean, total = [0.0] * len(res.classes), 0.0
            for day in predict.DAY_NAMES:
                w, p = native[key, day]
                mean, total = [a + b * w for a, b in zip(mean, p, strict=True)], total + w
            order = sorted((-m / total, i) for i, m in enumerate(mean))[:2]
            expected |= {(key, rank): (res.classes[i], -m) for rank, (m, i) in enumerate(order, 1)}
        best, ranked = predict.score_scenarios(res.model, res.classes, pts, "key", weights, top=2)
        assert {(r["key"], r["rank"]): (r["class"], r["probability"]) for r in ranked.collect()} == expected
        assert {r["key"]: (r["prediction"], r["confidence"]) for r in best.collect()} == {k: v for (k, rank), v in expected.items() if rank == 1}
        assert ranked.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_expand_days_weights(spark):
    pts = spark.createDataFrame([(1,)], "key long")
    rows = predict.expand_days(pts).collect()
    assert len(rows) == 7 and abs(sum(r["day_weight"] for r in rows) - 1.0) < 1e-12
    rows = predict.expand_days(pts, {"Monday": 3.0, "Tuesday": 1.0}).collect()
    w = {r["day"]: r["day_weight"] for r in rows}
    assert w["Monday"] == 0.75 and w["Sunday"] == 0.0


def test_impute_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "d string")
    assert [r["d"] for r in ml.impute_mode(df, ["d"]).collect()] == ["b", "a", "a", "b", "a"]


def test_schema_helpers(spark):
    assert schema.place_column(["id", "n_regionkey", "City"]) == "n_regionkey"
    assert schema.place_column(["id", "value"]) is None
    assert schema.place_column(["Crime Description", "output"]) == "output"  # 'ut' substring trap
    assert schema.aliased_column(["x", "DAY_NAME ", "weekday"]) == "weekday"
    assert schema.aliased_column([" Day of Week", "day of week"]) == "day of week"
    df = spark.createDataFrame([(1, "a", 2.0)], "k long, s string, d double")
    assert schema.string_columns(df) == ["s"]
    with pytest.raises(ValueError, match="Missing required columns"):
        schema.require_columns(df, ["k", "Hour", "Latitude"])
    assert schema.is_empty(df.limit(0))


def test_csv_missing_tokens(spark, scratch):
    path = os.path.join(scratch, "in.csv")
    with open(path, "w") as fh:
        fh.write("cat,hour,day\nTheft,3,Mon\nNA,4,nan\n,5,\nAssault,nan,Fri\n")
    df = files.read_csv_na(spark, path, "cat string, hour double, day string")
    rows = df.collect()
    assert rows[1]["cat"] is None and rows[1]["day"] is None and rows[2]["cat"] is None
    kept = clean.drop_nulls(df, ["cat", "hour", "day"]).count()
    assert kept == 1
    raw = files.read_raw_csv(spark, path, "cat string, hour double, day string")
    assert clean.drop_any_null(raw).count() == 2  # Spark alone nulls only the empty field and bad numbers


def test_replicate_one_scan(spark):
    df = spark.range(10).withColumnRenamed("id", "key").withColumn("category", F.lit("a"))
    rep = replicate.simulate_place_time(replicate.replicate(df, 3), ColumnRoles())
    rows = rep.collect()
    assert len(rows) == 30 and len({(r["key"], r["copy"]) for r in rows}) == 30
    assert len({r["lat"] for r in rows}) == 30
    assert "Union" not in rep._jdf.queryExecution().optimizedPlan().toString()


def test_prepare_and_report_jobs(spark, scratch):
    src = fixtures.incidents_place(spark, SF_SMALL).select("key", "category", "region", "nation")
    res = jobs.prepare(src, ColumnRoles(), os.path.join(scratch, "prep"), term="ASIA", train=True)
    n_src = src.where(F.col("region").contains("ASIA")).count()
    assert res.location_column == "region" and res.rows.count() == 3 * n_src
    assert res.predictions is not None and res.predictions.count() > 0
    paths = jobs.build_report(fixtures.incidents(spark, SF_SMALL), ROLES, os.path.join(scratch, "rep"), restarts=1, preset="small")
    assert {"correlation", "hourly", "summary", "heatmap", "centers", "model_status"} <= set(paths)
    assert spark.read.parquet(paths["hourly"]).count() == 24


def test_streaming_hourly_counts(spark, scratch):
    src = os.path.join(scratch, "stream_in")
    inc = fixtures.incidents(spark, SF_SMALL)
    inc.write.parquet(src)
    stream = spark.readStream.schema(inc.schema).parquet(src)
    q = (hourly_counts_stream(stream, ROLES).writeStream.outputMode("complete").format("memory")
         .queryName("hourly_test").option("checkpointLocation", os.path.join(scratch, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = {r["hour"]: r["n"] for r in spark.sql("SELECT * FROM hourly_test").collect()}
    want = {r["hour"]: r["n"] for r in inc.groupBy("hour").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_one_hot_unknown_is_all_zeros(spark):
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    enc = ml.one_hot(train, ["c"])
    got = sorted(tuple(r[0]) for r in enc.select(vector_to_array("cat__c")).collect())
    assert got == [(0.0, 1.0), (1.0, 0.0), (1.0, 0.0)]
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    idx = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(train)
    ohe = OneHotEncoder(inputCols=["i"], outputCols=["v"], dropLast=True).fit(idx.transform(train))
    unseen = spark.createDataFrame([("zz",), (None,)], "c string")
    vecs = [tuple(r[0]) for r in ohe.transform(idx.transform(unseen)).select(vector_to_array("v")).collect()]
    assert vecs == [(0.0, 0.0), (0.0, 0.0)]


def _feature_rows(n, classes):
    return [(i, classes[i % len(classes)], 28.5 + i * 1e-3, 77.1, i % 24, 0.1, 0.9, "Night", "Monday", "0")
            for i in range(n)]


FEATURE_SCHEMA = ("key long, category string, lat double, lon double, hour int, hour_sin double, hour_cos double, "
                  "time_band string, day string, cluster_id string")


def test_gate_19_vs_20_rows(spark):
    nineteen = spark.createDataFrame(_feature_rows(19, ["a", "b"]), FEATURE_SCHEMA)
    twenty = spark.createDataFrame(_feature_rows(20, ["a", "b"]), FEATURE_SCHEMA)
    assert not ml.train_classifier(nineteen, "category", "key").ready
    res = ml.train_classifier(twenty, "category", "key")
    assert res.ready and res.training_rows == 20


def test_single_row_class_falls_back_to_keyed_split(spark):
    rows = _feature_rows(40, ["a", "b"]) + [(999, "lonely", 28.6, 77.2, 5, 0.1, 0.9, "Morning", "Friday", "0")]
    res = ml.train_classifier(spark.createDataFrame(rows, FEATURE_SCHEMA), "category", "key")
    assert res.ready and res.predictions.count() > 0


def test_one_row_and_null_category(spark):
    one = spark.createDataFrame([(1, "a", 28.5, 77.2, 5)], "key long, category string, lat double, lon double, hour int")
    from placetime.operators import aggregates as agg

    assert agg.summary_stats(one, "category", "hour").count() == 4
    out, fit = spatial.attach_clusters(one, ColumnRoles())
    assert fit is None and out.first()["cluster_id"] == "0"
    nulls = spark.createDataFrame([(1, None, 28.5, 77.2, 5.0), (2, "a", 28.5, 77.2, 5.0)],
                                  "key long, category string, lat double, lon double, hour double")
    assert [r["category"] for r in clean.coerce_incidents(nulls, ColumnRoles()).collect()] == ["nan", "a"]
    assert clean.coerce_incidents(nulls, ColumnRoles(), missing="?").first()["category"] == "?"
    assert clean.coerce_incidents(nulls, ColumnRoles(), missing=None).count() == 1


def test_class_only_in_test_rows_is_scored(spark):
    from placetime.operators import split as sp

    rows = _feature_rows(60, ["a", "b"])
    # find a key that the keyed split sends to the test side and give it its own class
    df = spark.createDataFrame(rows, FEATURE_SCHEMA)
    test_key = sp.keyed_split(df, "key", 0.25, 42).where("is_test").first()["key"]
    rows = [(k, "only_test" if k == test_key else c, *rest) for k, c, *rest in rows]
    preset = ml.ForestPreset(num_trees=5, max_depth=3, stratified=False)
    res = ml.train_classifier(spark.createDataFrame(rows, FEATURE_SCHEMA), "category", "key", preset)
    assert res.ready and "only_test" not in res.classes
    labels = {r["label"] for r in res.predictions.collect()}
    assert "only_test" in labels


def test_unusable_preset_is_reported(spark):
    bad = ml.ForestPreset(num_trees=2, max_depth=-1)
    res = ml.train_classifier(spark.createDataFrame(_feature_rows(40, ["a", "b"]), FEATURE_SCHEMA),
                              "category", "key", bad)
    assert not res.ready and res.prior is not None and res.training_rows == 40


def test_failing_job_raises(spark):
    rows = spark.createDataFrame(_feature_rows(40, ["a", "b"]), FEATURE_SCHEMA)
    broken = rows.withColumn("lat", F.when(F.col("key") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("lat")))
    with pytest.raises(Exception, match="lost"):
        ml.train_classifier(broken, "category", "key")


def test_training_record(spark):
    res = ml.train_classifier(spark.createDataFrame(_feature_rows(40, ["a", "b"]), FEATURE_SCHEMA), "category", "key")
    row = ml.status_frame(spark, res).first()
    right = res.predictions.where("label = prediction").count() / res.predictions.count()
    assert row["ready"] and row["stratified"] and abs(row["accuracy"] - right) < 1e-12


def test_start_hourly_counts_on_files(spark, scratch):
    from placetime.streaming import start_hourly_counts

    src = os.path.join(scratch, "feed")
    inc = fixtures.incidents(spark, SF_SMALL)
    inc.write.parquet(src)
    q = start_hourly_counts(spark, src, inc.schema, ROLES, os.path.join(scratch, "ck2"), name="hourly_feed")
    q.processAllAvailable()
    q.stop()
    got = {r["hour"]: r["n"] for r in spark.sql("SELECT * FROM hourly_feed").collect()}
    assert sum(got.values()) == inc.count() and len(got) <= 24


def test_training_rows_are_worked_out_once(spark, monkeypatch):
    """The filter for complete rows reads the held rows: below them it would repeat each column's expression."""
    seen = {}
    monkeypatch.setattr(ml, "_gated", lambda data, *_: seen.update(plan=data._jdf.queryExecution().optimizedPlan().toString(), n=data.count()))
    rows = fixtures.incidents(spark, SF_SMALL)
    base = spatial.assign_centers(clean.prepare_base(rows, ROLES), "lat", "lon", [(28.5, 77.1), (28.8, 77.4)])
    ml.train_classifier(base, "category", "key", "batch")
    above, _held = seen["plan"].split("InMemoryRelation", 1)
    assert "Filter" in above and "md5" not in above and seen["n"] == rows.count()
