"""Range and two-way bucketing (D15-D17) as native CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``c < edges[0] -> labels[0]``, ``c < edges[1] -> labels[1]`` … else the last label.

    Same as a searched CASE: a value below the first edge (negative ages
    included) takes the first label, and null falls to the last label.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for edge, label in zip(edges, labels[:-1]):
        cond = col < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def two_way(cond: Column, yes: str, no: str) -> Column:
    """Label by a condition; null condition -> ``no``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))
