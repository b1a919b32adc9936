"""Ordering, top-k and best-row-per-group.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
its own k best rows and only those reach the final merge, so top-k never
sorts or moves the whole input.  Ordering always ends with a tie key so the
same input gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Sequence[str | Column]


def _order(spec: OrderSpec) -> list[Column]:
    return [F.col(s) if isinstance(s, str) else s for s in spec]


def top_k(df: DataFrame, order: OrderSpec, k: int) -> DataFrame:
    """The first ``k`` rows by ``order``."""
    return df.orderBy(*_order(order)).limit(k)


def top_k_with_position(
    df: DataFrame, order: OrderSpec, k: int, position: str = "position"
) -> DataFrame:
    """Top-k plus a 1-based position.

    The position window runs over the k rows left after the limit (a
    bounded single-partition window), never over the input.
    """
    cols = _order(order)
    top = df.orderBy(*cols).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*cols)).alias(position), *df.columns)


def best_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: OrderSpec,
    rank_name: str = "rank_num",
    keep_rank: bool = False,
) -> DataFrame:
    """W1 + F13: the first row per group by ``order`` (row_number() = 1).

    Catalyst turns the ``= 1`` filter into a WindowGroupLimit that is applied
    before and after the shuffle, so each task forwards one row per group.
    """
    w = Window.partitionBy(*group).orderBy(*_order(order))
    ranked = df.withColumn(rank_name, F.row_number().over(w))
    best = ranked.where(F.col(rank_name) == 1)
    return best if keep_rank else best.drop(rank_name)


def sort_by(df: DataFrame, order: OrderSpec) -> DataFrame:
    """A total order (range-partitioned sort)."""
    return df.orderBy(*_order(order))


def preview(df: DataFrame, n: int, order: OrderSpec | None = None) -> DataFrame:
    """The first ``n`` rows, by ``order`` when given (deterministic)."""
    return top_k(df, order, n) if order else df.limit(n)
