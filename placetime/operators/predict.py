"""Scenario scoring: features for a table of (hour, lat, lon) points,
expansion over the seven days, day-averaged class probabilities, and the
baseline answer when no model exists.

Points are a DataFrame, so a batch of millions of scenarios scores in
parallel.  Scoring keeps a point's seven day variants in one row, so averaging
and ranking need no shuffle by key; ``expand_days`` gives the same variants as
rows when wanted.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.features import clip_hour, hour_cos, hour_sin, in_domain, time_band
from ..roles import DAY_NAMES, TIME_BANDS
from .aggregates import top_category
from .joins import shuffle_partitions
from .spatial import nearest_center_expr
from .trees import TableForest, flat_forest, forest_nodes, mean_probability, shares

# Tasks get this module's functions with the job, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranked rows of an Arrow batch that leaves a task.
RANKED_ROWS = 1 << 16


def scenario_features(points: DataFrame, hour: str = "hour", lat: str = "lat", lon: str = "lon",
                      centers: Sequence[tuple[float, float]] | None = None,
                      cluster: str = "cluster_id") -> DataFrame:
    """hour (clipped), hour_sin, hour_cos, time_band and nearest cluster id
    ("0" without centers) for each point."""
    h = clip_hour(F.col(hour).cast("double"))
    out = points.withColumns({hour: h, lat: F.col(lat).cast("double"), lon: F.col(lon).cast("double")})
    out = out.withColumns({
        "hour_sin": hour_sin(hour),
        "hour_cos": hour_cos(hour),
        "time_band": in_domain(time_band(hour), TIME_BANDS),
    })
    if centers:
        cid = nearest_center_expr(F.col(lat), F.col(lon), centers).cast("string")
    else:
        cid = F.lit("0")
    return out.withColumn(cluster, cid)


def _day_weights(weights: dict[str, float] | None) -> list[tuple[str, float]]:
    tot = sum(max(0.0, float(weights.get(d, 0.0))) for d in DAY_NAMES) if weights else 0.0
    if tot <= 0:
        return [(d, 1.0 / len(DAY_NAMES)) for d in DAY_NAMES]
    return [(d, max(0.0, float(weights.get(d, 0.0))) / tot) for d in DAY_NAMES]


def expand_days(points: DataFrame, weights: dict[str, float] | None = None, day: str = "day",
                weight: str = "day_weight") -> DataFrame:
    """Seven rows per point, one per day, with the day's weight.

    The original weighted by a prior that, as written, is always uniform;
    uniform 1/7 is the default, a real day prior may be passed.
    """
    arr = F.array(*[F.struct(F.lit(d).alias(day), F.lit(w).alias(weight)) for d, w in _day_weights(weights)])
    return points.select("*", F.inline(arr))


def score_scenarios(model, classes: Sequence[str], points: DataFrame, key: str = "key",
                    weights: dict[str, float] | None = None, day: str = "day", top: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Day-averaged class probabilities per point, without a shuffle by key.

    ``model`` is the fitted pipeline (label indexer, preprocessing stages,
    forest).  Points are dealt evenly over the tasks and preprocessed once with
    an unknown day (an all-zero day block); each day variant sets its day's
    one-hot slot in that vector.  A task walks the forest's trees for a block of
    points and their variants at once and averages the variants there
    (``trees.mean_probability``); only a point's asked ranks leave the block.  With
    a ``TableForest`` the variants of each different cell are scored once, by a job,
    and their average is joined to the points of the cell.

    Returns (best, ranked): best = (key, prediction, confidence), the first
    class in order on ties; ranked = (key, class, probability, rank), with
    ranks up to ``top`` (None: all).
    """
    from .ml import feature_names

    stages = list(model.stages)
    prep, forest = stages[1:-1], stages[-1]
    # Preprocess once with an unknown day: its one-hot block is all zeros.
    x = points.repartition(shuffle_partitions(points)).withColumn(day, F.lit(None).cast("string"))
    for st in prep:
        x = st.transform(x)
    fcol = forest.getFeaturesCol()
    names = feature_names(x.schema[fcol].metadata)
    x = x.select(key, vector_to_array(fcol).alias("_base"))
    # A day unseen in training stays all-zero, as one-hot "ignore" does.
    slots = [names.index(f"cat__{day}_{d}") if f"cat__{day}_{d}" in names else None for d in DAY_NAMES]
    of_days = [w for _, w in _day_weights(weights)]
    if isinstance(forest, TableForest):
        x, flat, width = _with_means(forest, x, key, slots, of_days), None, len(classes)
    else:
        flat, width = flat_forest(forest_nodes(points.sparkSession, forest), slots), forest.numFeatures

    def means(batches):
        for batch in batches:
            if batch.num_rows:
                held = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
                yield batch.column(0), held if flat is None else mean_probability(flat, held, slots, of_days)

    def first(batches):
        for keys, mean in means(batches):
            yield pa.RecordBatch.from_arrays([keys, pa.array(mean.argmax(axis=1).astype(np.int32)), pa.array(mean.max(axis=1))], ["key", "i", "p"])

    def ranks(batches):
        for keys, mean in means(batches):
            order = np.argsort(-mean, axis=1, kind="stable")[:, :top]
            n, many = order.shape
            p = np.take_along_axis(mean, order, axis=1)
            for a in range(0, n, step := max(1, RANKED_ROWS // many)):
                held = len(order[a : a + step])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(np.repeat(np.arange(a, a + held), many))), pa.array(order[a : a + step].ravel().astype(np.int32)),
                     pa.array(p[a : a + step].ravel()), pa.array(np.tile(np.arange(1, many + 1), held))], ["key", "i", "p", "rank"])

    cls = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("i") + 1)
    of_point = [StructField("key", x.schema[key].dataType), StructField("i", IntegerType()), StructField("p", DoubleType())]
    best = x.mapInArrow(first, StructType(of_point)).select(
        F.col("key").alias(key), cls.alias("prediction"), F.col("p").alias("confidence"))
    ranked = x.mapInArrow(ranks, StructType([*of_point, StructField("rank", LongType())])).select(
        F.col("key").alias(key), cls.alias("class"), F.col("p").alias("probability"), "rank")
    return best, ranked


def _with_means(forest: TableForest, x: DataFrame, key: str, slots: Sequence[int | None], of_days: Sequence[float]) -> DataFrame:
    """(key, class probabilities of the point averaged over its day variants), for points (key, ``_base``)."""
    x = x.select(key, forest.cell("_base").alias("_cell"))
    days = [F.struct(F.lit(d).alias("d"), F.lit(w).alias("w"), (F.col("_cell") if slot is None else forest.with_slot(F.col("_cell"), slot, 1.0)).alias("cell"))
            for d, (slot, w) in enumerate(zip(slots, of_days, strict=True))]
    variants = x.select("_cell").distinct().select("_cell", F.inline(F.array(*days)))
    each = variants.join(forest.votes(variants.select("cell")), "cell").withColumn("p", shares("votes"))
    held = each.groupBy("_cell").agg(F.array_sort(F.collect_list(F.struct("d", "w", "p"))).alias("held"))
    none = F.array_repeat(F.lit(0.0), forest.numClasses)
    added = F.aggregate("held", none, lambda a, v: F.zip_with(a, v["p"], lambda s, p: s + p * v["w"]))
    total = float(np.cumsum(of_days)[-1])
    return x.join(held.select("_cell", F.transform(added, lambda s: s / F.lit(total)).alias("_mean")), "_cell").select(key, "_mean")


def top_probabilities(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most probable classes per point (ranks are per row already)."""
    return ranked.where(F.col("rank") <= F.lit(int(n)))


def baseline_prediction(df: DataFrame, category: str) -> DataFrame:
    """Most frequent category and its share (used when no model exists)."""
    return top_category(df, category, "confidence").withColumnRenamed(category, "prediction")
