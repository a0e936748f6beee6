"""Spatial operators: density grid, category and cluster slots, legends and
map points, the cluster-count rule, nearest-center assignment, K-means whose
restarts share every pass, and cluster summaries.

Centers are at most six points, so nearest-center assignment is a handful
of column expressions evaluated per row (no join at all).  Grid extents are
one aggregate row used as literals.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import hour_intensity
from ..roles import (
    ALL_LEGEND_LABEL,
    CLUSTER_MAX,
    CLUSTER_MIN,
    CLUSTER_ROWS_PER_STEP,
    INTENSITY_LEGEND,
    LEGEND_ROWS,
    MAP_INTENSITY,
    MAP_TYPE,
    PALETTE_SLOTS,
    ColumnRoles,
)
from .joins import shuffle_partitions
from .sort import rank_small, top_rows, with_position

# Tasks get this module's functions with the job, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID_BINS = 30


# ---------------------------------------------------------------------------
# Density grid
# ---------------------------------------------------------------------------
def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin on [lo, hi], top edge closed; hi == lo puts all in the middle."""
    width = hi - lo
    raw = F.floor((x - lo) / width * F.lit(bins))
    return F.when(width == 0, F.lit(bins // 2)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def density_grid(df: DataFrame, x: str, y: str, bins: int = GRID_BINS) -> DataFrame:
    """(x_bin, y_bin, n) for the non-empty cells of a bins x bins grid over
    the data's [min, max] extents.

    The extents are one aggregate row, fetched once and used as literals
    (a scalar subquery would be re-run for every reference to it).
    """
    # NaN and infinity would stretch the extents: a point needs two finite coordinates.
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    pts = df.where(finite(x) & finite(y))
    ext = pts.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if ext is None or ext["x0"] is None:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, n long")
    lit = {k: F.lit(float(ext[k])) for k in ("x0", "x1", "y0", "y1")}
    binned = pts.select(_bin(F.col(x), lit["x0"], lit["x1"], bins).alias("x_bin"),
                        _bin(F.col(y), lit["y0"], lit["y1"], bins).alias("y_bin"))
    return binned.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Slots, legends, map points
# ---------------------------------------------------------------------------
def category_slots(df: DataFrame, category: str, slots: int = PALETTE_SLOTS) -> DataFrame:
    """(category, idx, slot): sorted distinct categories, slot = idx mod slots."""
    ranked = with_position(df.select(category).where(F.col(category).isNotNull()).distinct(),
                        [F.col(category).asc()], "idx")
    return ranked.select(category, (F.col("idx") - 1).alias("idx"),
                         F.pmod(F.col("idx") - 1, F.lit(int(slots))).cast("int").alias("slot"))


def cluster_slots(df: DataFrame, cluster: str, slots: int | None = None) -> DataFrame:
    """(cluster, idx[, slot]): distinct cluster ids ordered as integers."""
    ids = df.select(cluster).where(F.col(cluster).isNotNull()).distinct()
    ranked = rank_small(ids, [F.col(cluster).cast("long").asc(), F.col(cluster).asc()], "idx")
    out = ranked.withColumn("idx", (F.col("idx") - 1).cast("long"))
    if slots:
        out = out.withColumn("slot", F.pmod(F.col("idx"), F.lit(int(slots))).cast("int"))
    return out


def map_points(df: DataFrame, roles: ColumnRoles, mode: str) -> DataFrame:
    """(category, lat, lon, hour[, intensity | slot]) without nulls.

    Any mode other than intensity or type gives the plain points.  Type mode
    joins the category slot table (one row per category).
    """
    from .joins import join_small

    pts = df.select(roles.category, roles.lat, roles.lon, roles.hour).na.drop(how="any")
    if mode == MAP_INTENSITY:
        return pts.withColumn("intensity", hour_intensity(roles.hour))
    if mode == MAP_TYPE:
        slots = category_slots(pts, roles.category).select(roles.category, "slot")
        return join_small(pts, slots, roles.category, "left")
    return pts


def legend(df: DataFrame, roles: ColumnRoles, mode: str) -> DataFrame:
    """(label, slot, pos) legend rows for a map mode.

    Type: the first 12 categories in sorted order with their slot.
    Intensity: the three bands with their hour ranges.  Otherwise one row.
    An empty point set gives no rows.
    """
    spark = df.sparkSession
    pts = df.select(roles.category, roles.lat, roles.lon, roles.hour).na.drop(how="any")
    if mode == MAP_TYPE:
        top = top_rows(pts.select(roles.category).distinct(), [F.col(roles.category).asc()], LEGEND_ROWS)
        slot = F.pmod(F.col("pos") - 1, F.lit(PALETTE_SLOTS)).cast("int")
        return top.select(F.col(roles.category).alias("label"), slot.alias("slot"), "pos")
    if mode == MAP_INTENSITY:
        rows = [(lbl, i, i + 1) for i, lbl in enumerate(INTENSITY_LEGEND)]
    else:
        rows = [(ALL_LEGEND_LABEL, 0, 1)]
    lit_rows = spark.createDataFrame(rows, "label string, slot int, pos long")
    any_point = pts.limit(1).select(F.count(F.lit(1))).scalar()
    return lit_rows.where(any_point > 0)


# ---------------------------------------------------------------------------
# Clustering
# ---------------------------------------------------------------------------
def cluster_count_expr(n: Column, multi_point: Column) -> Column:
    """k = min(6, max(2, n // 250 + 2)), at most n; 0 when clustering is off
    (fewer than 3 rows or fewer than 2 distinct points)."""
    k = F.least(F.lit(CLUSTER_MAX), F.greatest(F.lit(CLUSTER_MIN), F.floor(n / CLUSTER_ROWS_PER_STEP) + 2))
    k = F.least(k, n)
    return F.when((n < 3) | ~multi_point | (k < CLUSTER_MIN), F.lit(0)).otherwise(k).cast("int")


def cluster_plan(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """One row: n, whether there are at least two distinct points, and k.

    "At least two distinct points" holds exactly when latitude or longitude
    varies, so the gate is a min/max aggregate (no distinct shuffle).
    """
    pts = df.select(lat, lon).na.drop(how="any")
    agg = pts.agg(F.count(F.lit(1)).alias("n"),
                  ((F.max(lat) > F.min(lat)) | (F.max(lon) > F.min(lon))).alias("multi_point"))
    agg = agg.withColumn("multi_point", F.coalesce(F.col("multi_point"), F.lit(False)))
    return agg.withColumn("k", cluster_count_expr(F.col("n"), F.col("multi_point")))


def nearest_center_expr(lat: Column, lon: Column, centers: Sequence[tuple[float, float]]) -> Column:
    """Index of the nearest center (squared distance, lowest index on ties)."""
    items = []
    for i, (clat, clon) in enumerate(centers):
        dlat = lat - F.lit(float(clat))
        dlon = lon - F.lit(float(clon))
        items.append(F.struct((dlat * dlat + dlon * dlon).alias("d"), F.lit(i).alias("id")))
    return F.array_min(F.array(*items))["id"]


def assign_centers(df: DataFrame, lat: str, lon: str, centers: Sequence[tuple[float, float]],
                   name: str = "cluster") -> DataFrame:
    """Attach the nearest center's index and its string id."""
    idx = nearest_center_expr(F.col(lat), F.col(lon), centers)
    return df.withColumns({name: idx, f"{name}_id": idx.cast("string")})


def cluster_summary(df: DataFrame, cluster: str, lat: str, lon: str) -> DataFrame:
    """Size and mean coordinates per cluster."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("records"), F.avg(lat).alias("avg_lat"),
                                   F.avg(lon).alias("avg_lon"))


@dataclass
class ClusterFit:
    k: int
    centers: list[tuple[float, float]]  # canonical order: by (lat, lon)
    cost: float | None
    iterations: int = 0  # of the restart that won
    restart: int = 0


# Restarts per clustering, as in the reference (its learner ran 10 initialisations).
KMEANS_RESTARTS = 10
# A restart stops when its centers' squared moves are below this share of the mean variance ...
KMEANS_TOLERANCE = 1e-4
# ... and the best one goes on until they are below this.
KMEANS_FIXED = 1e-16

Centers = dict[int, list[tuple[float, float]]]  # by restart


def _numbers(values: Sequence[float]) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def seed_centers(points: DataFrame, k: int, seed: int, restarts: int) -> Centers:
    """k-means++ over all points, every restart in the same ``k`` aggregates of batches.

    The point of least ``-ln(1 - u) / w`` is a draw in proportion to w; u is keyed
    by (seed, restart, step, key) and w the squared distance to the nearest center
    so far, so a draw needs no running sum and is the same in every run.  Where all
    points lie on centers, the last center is repeated.
    """
    centers: Centers = {r: [] for r in range(restarts)}
    types = f"restart int, s double, key {points.schema['key'].dataType.simpleString()}, lat double, lon double"
    for step in range(k):
        digests = [f"md5(concat_ws('|', 'km{seed}-{step}-{i}', CAST(key AS STRING))) AS h{i}" for i in range((restarts + 3) // 4)]
        least = points.selectExpr("key", "lat", "lon", *digests).mapInArrow(_least_draws(dict(centers)), types)
        rows = least.groupBy("restart").agg(F.min(F.struct("s", "key", "lat", "lon")).alias("m")).collect()  # a row per restart
        found = {r["restart"]: (float(r["m"]["lat"]), float(r["m"]["lon"])) for r in rows}
        for r, own in centers.items():
            own.append(found[r] if r in found else own[-1])
    return centers


def _words(digests: pa.Array) -> np.ndarray:
    """The four leading-to-trailing 32-bit words of each hex digest."""
    digit = np.frombuffer("".join(digests.to_pylist()).encode(), np.uint8).reshape(-1, 4, 8).astype(np.int64)
    digit = np.where(digit >= 97, digit - 87, digit - 48)
    return digit @ (16 ** np.arange(7, -1, -1))


def _least_draws(centers: Centers):
    """For ``mapInArrow``: of each batch and restart, the points with the least score (all, if several)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lat, lon = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon"))
            words = [_words(batch.column(f"h{i}")) for i in range((len(centers) + 3) // 4)]
            for r, own in centers.items():
                score = -np.log(1.0 - words[r // 4][:, r % 4] / 4294967296.0)
                if own:
                    away = np.min([(lat - a) * (lat - a) + (lon - b) * (lon - b) for a, b in own], axis=0)
                    on = np.flatnonzero(away > 0)
                    score = score[on] / away[on]
                else:
                    on = np.arange(len(lat))
                if len(on):
                    at = pa.array(on[score == score.min()])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r, np.int32)), pa.array(np.full(len(at), score.min())),
                                                      *(batch.column(c).take(at) for c in ("key", "lat", "lon"))], names=["restart", "s", "key", "lat", "lon"])
    return run


def _nearest_sums(points: DataFrame, centers: Centers) -> DataFrame:
    """(restart, id, n, lat, lon, cost): number, coordinate sums and squared distances of the points nearest to each center.

    A batch of points is summed by restart and center in its task (ties: the lowest center); Spark adds the batches up.
    """
    own = {r: (np.array([a for a, _ in c]), np.array([b for _, b in c])) for r, c in sorted(centers.items())}
    schema = pa.schema([("restart", pa.int32()), ("id", pa.int32()), ("n", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("cost", pa.float64())])

    def run(batches):
        for batch in batches:
            lat, lon = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for r, (la, lo) in own.items():
                near, best = np.zeros(len(lat), np.int64), (lat - la[0]) * (lat - la[0]) + (lon - lo[0]) * (lon - lo[0])
                for i in range(1, len(la)):
                    d = (lat - la[i]) * (lat - la[i]) + (lon - lo[i]) * (lon - lo[i])
                    near[d < best] = i
                    best = np.minimum(best, d)
                n = np.bincount(near, minlength=len(la))
                at = np.flatnonzero(n)
                sums = [np.bincount(near, v, len(la))[at] for v in (lat, lon, best)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((np.full(len(at), r), at, n[at], *sums), schema.types, strict=True)], schema=schema)

    types = "restart int, id int, n long, lat double, lon double, cost double"
    parts = points.select("lat", "lon").mapInArrow(run, types)
    return parts.groupBy("restart", "id").agg(*[F.sum(c).alias(c) for c in ("n", "lat", "lon", "cost")])


def _costs(points: DataFrame, centers: Centers) -> dict[int, float]:
    """Each restart's sum of squared distances."""
    found = {r: 0.0 for r in centers}
    for s in _nearest_sums(points, centers).collect():  # restarts x k rows at most
        found[s["restart"]] += s["cost"]
    return found


def _move(points: DataFrame, centers: Centers) -> tuple[Centers, dict[int, float]]:
    """Centers at the means of their points (those without any stay) and each restart's squared move; one aggregate."""
    moved = {r: list(own) for r, own in centers.items()}
    for s in _nearest_sums(points, centers).collect():  # restarts x k rows at most
        moved[s["restart"]][s["id"]] = (s["lat"] / s["n"], s["lon"] / s["n"])
    return moved, {r: sum((a - x) ** 2 + (b - y) ** 2 for (a, b), (x, y) in zip(own, centers[r], strict=True)) for r, own in moved.items()}


def _settle(points: DataFrame, centers: Centers, tolerance: float, max_iter: int) -> tuple[Centers, dict[int, int]]:
    """Lloyd rounds of all restarts at once; a restart leaves when its squared move is within ``tolerance``."""
    done: Centers = {}
    rounds = {}
    for i in range(1, max_iter + 1):
        if not centers:
            break
        centers, moves = _move(points, centers)
        for r, move in moves.items():
            if move <= tolerance or i == max_iter:
                done[r], rounds[r] = centers.pop(r), i
    return done, rounds


def fit_kmeans(df: DataFrame, lat: str, lon: str, k: int, seed: int = 42, restarts: int = KMEANS_RESTARTS,
               max_iter: int = 300, key: str | None = None) -> ClusterFit:
    """K-means on (lat, lon) from several seedings; the lowest cost wins (ties: the first restart).

    All restarts share every pass over the points: a round is one aggregate by
    (restart, center), and restarts that have settled leave it.  The best one then
    goes on until its centers are the means of the points nearest to them.  Only
    restarts x k centers reach the driver.  Draws are keyed by ``key`` (without
    one, by the coordinates), so the fit does not depend on the partitioning.
    Centers are renumbered in (lat, lon) order so ids are canonical.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    label = F.col(key) if key else F.concat_ws(" ", F.col(lat).cast("string"), F.col(lon).cast("string"))
    # Read in every round: held once, and the finite points taken from there, since below it the filter would work the coordinates out again.
    held = df.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), label.alias("key"))
    held = held.repartition(shuffle_partitions(df), "key").persist(StorageLevel.MEMORY_AND_DISK)
    points = held.where(finite("lat") & finite("lon"))
    try:
        spread = points.agg(((F.var_pop("lat") + F.var_pop("lon")) / 2).alias("v")).first()["v"] or 0.0
        centers = seed_centers(points, int(k), int(seed), max(1, int(restarts)))
        settled, rounds = _settle(points, centers, KMEANS_TOLERANCE * spread, max_iter)
        best = min((cost, r) for r, cost in _costs(points, settled).items())[1]
        last, more = _settle(points, {best: settled[best]}, KMEANS_FIXED, max_iter)
        cost = _costs(points, last)[best]
    finally:
        held.unpersist()
    return ClusterFit(int(k), sorted(last[best]), float(cost), rounds[best] + more[best], best)


def attach_clusters(df: DataFrame, roles: ColumnRoles, seed: int = 42, restarts: int = KMEANS_RESTARTS,
                    name: str = "cluster_id") -> tuple[DataFrame, ClusterFit | None]:
    """Cluster rows on coordinates with the k rule; string ids, "0" when off.

    Returns the frame with ``name`` and the fit (None when clustering is off).
    """
    plan = cluster_plan(df, roles.lat, roles.lon).first()
    k = int(plan["k"]) if plan is not None else 0
    if k < CLUSTER_MIN:
        return df.withColumn(name, F.lit("0")), None
    fit = fit_kmeans(df, roles.lat, roles.lon, k, seed, restarts, key=roles.key if roles.key in df.columns else None)
    idx = nearest_center_expr(F.col(roles.lat), F.col(roles.lon), fit.centers)
    out = df.withColumn(name, F.coalesce(idx.cast("string"), F.lit("0")))
    return out, fit


def centers_frame(spark, fit: ClusterFit | None) -> DataFrame:
    """(cluster, lat, lon) table of centers (k <= 6 rows)."""
    rows = [] if fit is None else [(str(i), c[0], c[1]) for i, c in enumerate(fit.centers)]
    return spark.createDataFrame(rows, "cluster string, lat double, lon double")
