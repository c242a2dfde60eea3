"""Bands that label a metric for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspan.functions.metrics import ColumnOrName, as_column

# Band edges of the four headline figures.
ANOMALY_EDGES = (0, 5, 15, 999999)
COST_EDGES = (0, 150000, 200000, 999999)
RENEWABLE_EDGES = (0, 15, 35, 60, 100)
RESERVE_EDGES = (-999, 5, 15, 999)


def band(
    value: ColumnOrName, edges: Sequence[float], labels: Sequence[str] | None = None
) -> Column:
    """Label of the interval ``[edge, next edge)`` that holds ``value``.

    The end bands are open: values below the first edge take the first label, values from
    the last edge on the last; only NULL has none. Labels default to ``"from-to"``.
    """
    pairs = list(zip(edges, edges[1:]))
    labels = list(labels) if labels else [f"{low}-{high}" for low, high in pairs]
    if len(labels) != len(pairs):
        raise ValueError(f"{len(edges)} edges need {len(pairs)} labels, got {len(labels)}")
    value = as_column(value)
    chain = F
    for (_, high), label in zip(pairs[:-1], labels):
        chain = chain.when(value < high, label)
    return chain.when(value.isNotNull(), labels[-1])
