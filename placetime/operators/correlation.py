"""Pearson correlation: the 8-feature matrix, its strongest pairs, and the
hour-versus-hourly-count coefficient.

All pairs come from ONE aggregate of co-moments: each keeps its count, means
and centered products, and partial ones merge pairwise, so the matrix costs one
pass over the data and nothing cancels for values far from zero.  ``F.corr`` is
avoided: under ANSI mode it raises on a constant column; here an undefined
coefficient is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import day_code, hour_cos, hour_sin, pair_label, time_code

# Feature order of the correlation matrix (fixed, as in the reference).
CORR_FEATURES = ("Hour", "Latitude", "Longitude", "Hour Sin", "Hour Cos", "Day Code", "Time Code", "Cluster Code")


def guarded_corr(a: str, b: str):
    """covar_pop / (stddev_pop * stddev_pop); null when a side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation_frame(df: DataFrame, hour: str, lat: str, lon: str, day: str, band: str,
                      cluster: str) -> DataFrame:
    """The eight numeric features plus ``_valid`` (no feature missing).

    Listwise deletion is applied inside the aggregate (``corr_matrix``)
    rather than with a filter, which Catalyst would push below this
    projection with every feature expression inlined.
    """
    out = df.select(
        F.col(hour).cast("double").alias("Hour"),
        F.col(lat).cast("double").alias("Latitude"),
        F.col(lon).cast("double").alias("Longitude"),
        hour_sin(hour).alias("Hour Sin"),
        hour_cos(hour).alias("Hour Cos"),
        day_code(day).alias("Day Code"),
        time_code(band).alias("Time Code"),
        F.col(cluster).try_cast("double").alias("Cluster Code"),
    )
    checks = [F.col(f"`{f}`").isNotNull() & ~F.isnan(F.col(f"`{f}`")) for f in CORR_FEATURES]
    valid = checks[0]
    for c in checks[1:]:
        valid = valid & c
    return out.withColumn("_valid", valid)


def corr_matrix(feats: DataFrame, features: Sequence[str] = CORR_FEATURES) -> DataFrame:
    """Long (feature_a, feature_b, r) for every ordered pair, diagonal included.

    One aggregate over all rows: ``var_pop`` of each feature and ``covar_pop`` of
    each pair.  Listwise deletion is applied inside it (``when(_valid, x)``): a
    row filter would be pushed below the feature projection with every feature
    expression inlined into it.  r is null for a constant feature, for one that
    has an infinite value, and without rows.
    """
    names = list(features)
    k = len(names)
    ok = F.col("_valid") if "_valid" in feats.columns else F.lit(True)
    x = feats.select(*[F.when(ok, F.col(f"`{f}`")).alias(f"x{i}") for i, f in enumerate(names)])
    aggs = [F.var_pop(f"x{i}").alias(f"p{i}_{i}") for i in range(k)]
    aggs += [F.covar_pop(f"x{i}", f"x{j}").alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1, k)]
    structs = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            moments = {"pij": f"p{min(i, j)}_{max(i, j)}", "pii": f"p{i}_{i}", "pjj": f"p{j}_{j}"}
            structs.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.lit(i).alias("i"), F.lit(j).alias("j"),
                                    *[F.col(c).alias(v) for v, c in moments.items()]))
    pairs = x.agg(*aggs).select(F.inline(F.array(*structs)))
    r = F.try_divide("pij", F.sqrt("pii") * F.sqrt("pjj"))
    return pairs.select("feature_a", "feature_b", "i", "j", F.when(~F.isnan(r), r).alias("r"))


def strongest_pairs(matrix: DataFrame, k: int = 5, pos: str = "pos") -> DataFrame:
    """Top ``k`` strict-upper-triangle pairs by |r| (undefined dropped), signed r kept."""
    from .sort import top_rows

    upper = matrix.where((F.col("i") < F.col("j")) & F.col("r").isNotNull() & ~F.isnan("r"))
    upper = upper.select(pair_label("feature_a", "feature_b").alias("pair"), "r", "i", "j")
    order = [F.abs(F.col("r")).desc(), F.col("i").asc(), F.col("j").asc()]
    return top_rows(upper, order, k, pos).select("pair", "r", pos)


def hour_count_corr(hourly: DataFrame, hour: str, value: str = "n") -> DataFrame:
    """Pearson r between hour and its count over the 24-row dense series."""
    return hourly.agg(guarded_corr(hour, value).alias("r"))
