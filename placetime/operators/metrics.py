"""Classification metrics on a (label, prediction) table: accuracy, the
full confusion grid, and a per-class report with summary rows.

The row table is reduced once to (label, prediction) cell counts, at most
classes^2 rows; everything after works on that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import materialize_small
from .sort import number_rows


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def cell_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def class_positions(cells: DataFrame, classes: Sequence[str] | None = None) -> DataFrame:
    """(label, pos): the classes of the cells (or those given) in order, from 1."""
    if classes is not None:
        found = cells.sparkSession.createDataFrame([(c,) for c in classes], "label string").distinct()
    else:
        both = cells.select(F.col("actual").alias("label")).union(cells.select(F.col("predicted").alias("label")))
        found = both.where(F.col("label").isNotNull()).distinct()
    return number_rows(materialize_small(found), [("label", True)])


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[str] | None = None) -> DataFrame:
    """(actual, predicted, n) over the full class x class grid, zeros included.

    Rows with a label outside ``classes`` are not counted.  The grid's k * k places
    are a range dealt over the tasks; each place finds its two classes by position
    and its count by an equality join, so no task holds the list of classes.
    """
    # One scan of the predictions: the cell counts (<= classes^2 rows) are
    # materialised and everything else reads them.
    cells = materialize_small(cell_counts(pred, label, prediction))
    positions = materialize_small(class_positions(cells, classes))
    k = positions.count()
    side = lambda name: positions.select(F.col("label").alias(name), F.col("pos").alias(f"_{name}"))
    places = pred.sparkSession.range(k * k).select((F.expr(f"id div {max(k, 1)}") + 1).alias("_actual"), (F.col("id") % max(k, 1) + 1).alias("_predicted"))
    grid = places.join(side("actual"), "_actual").join(side("predicted"), "_predicted").select("actual", "predicted")
    return grid.join(cells, ["actual", "predicted"], "left").na.fill({"n": 0})


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          classes: Sequence[str] | None = None) -> DataFrame:
    """(label, precision, recall, f1, support, pos): one row per class, then
    ``accuracy``, ``macro avg``, ``weighted avg``.  Zero division gives 0.

    As in the original table, the ``accuracy`` row repeats the accuracy in
    all four value columns.  Works on the cell counts; the zero cells of the grid
    add nothing to its sums.
    """
    cells = materialize_small(cell_counts(pred, label, prediction))
    positions = materialize_small(class_positions(cells, classes))
    known = positions.select(F.col("label"))
    if classes is not None:
        cells = cells.join(known.withColumnRenamed("label", "actual"), "actual").join(known.withColumnRenamed("label", "predicted"), "predicted")
    right = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("actual").alias("label")).agg(F.sum(right).alias("tp"), F.sum("n").alias("support"))
    predicted = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("pred_n"))
    per = positions.join(actual, "label", "left").join(predicted, "label", "left").na.fill({"tp": 0, "support": 0, "pred_n": 0})
    zero = F.lit(0.0)
    per = per.select(
        "label", "pos", "tp",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), zero).alias("recall"),
        F.col("support").cast("double").alias("support"),
    ).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                 F.col("precision") + F.col("recall")), zero))
    per = materialize_small(per)
    tot = per.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("support").alias("total"),
        F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"),
    )
    acc = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("total")), zero)

    def row(name, p, r, f, sup, o):
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        sup.cast("double").alias("support"), (F.col("k") + F.lit(o)).alias("pos"))

    def ratio(c):
        return F.coalesce(F.try_divide(F.col(c), F.col("total")), zero)

    summary = tot.select(F.inline(F.array(
        row("accuracy", acc, acc, acc, acc, 1),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf"), F.col("total"), 2),
        row("weighted avg", ratio("wp"), ratio("wr"), ratio("wf"), F.col("total"), 3),
    )))
    return per.select("label", "precision", "recall", "f1", "support", "pos").unionByName(summary)
