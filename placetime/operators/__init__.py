"""DataFrame operators: cleaning, filters, sorts, aggregates, matrices,
correlation, spatial, splits, metrics, the classifier and scenario scoring."""

from . import (
    aggregates,
    clean,
    correlation,
    filters,
    joins,
    metrics,
    ml,
    pivot,
    predict,
    quantile,
    replicate,
    sort,
    spatial,
    split,
)

__all__ = [
    "aggregates",
    "clean",
    "correlation",
    "filters",
    "joins",
    "metrics",
    "ml",
    "pivot",
    "predict",
    "quantile",
    "replicate",
    "sort",
    "spatial",
    "split",
]
