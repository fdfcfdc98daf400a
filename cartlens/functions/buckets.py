"""Bucketing expressions with fixed or given edges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment edges and labels.
RECENCY_EDGES = (-1, 60, 120, 220, math.inf)
RECENCY_LABELS = ("Recent", "Moderately Recent", "Not So Recent", "Inactive")
MONETARY_EDGES = (0, 50, 150, 300, 600)
MONETARY_LABELS = ("Low", "Medium", "High", "Very High")
LATE_EDGES = (-1, 0, 3, math.inf)
LATE_LABELS = ("No Late Deliveries", "Low", "High")
RFM_EDGES = (0, 3, 6, 9)
RFM_LABELS = ("Inactive", "Regular", "Engaged")


def cut(
    x: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """Label of the interval holding x; null outside the edges or for a null x.

    right=True closes intervals on the right, otherwise on the left.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        tests = []
        if low != -math.inf:
            closed = (not right) or (include_lowest and i == 0)
            tests.append(x >= low if closed else x > low)
        if high != math.inf:
            tests.append(x <= high if right else x < high)
        test = tests[0]
        for extra in tests[1:]:
            test = test & extra
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """0-based right-closed bin over the distinct edges; equal edges collapse and the
    smallest value is in bin 0. Null for a null x."""
    inner = sorted(set(edges))[1:-1]
    index = F.lit(0)
    for edge in inner:
        index = index + F.when(x > F.lit(float(edge)), 1).otherwise(0)
    return F.when(x.isNotNull(), index)


def log_shifted(x: Column, shift: float = 0.0, passes: int = 1) -> Column:
    """log(1 + x + shift), applied passes times."""
    for _ in range(passes):
        x = F.log1p(x + F.lit(float(shift)))
    return x
