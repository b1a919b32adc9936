"""Quantile sketches that are stored and merged.

``percentile_approx`` has to see all rows again whenever some are added.  A KLL sketch of
``k`` items is a few kilobytes and can be merged with others: each batch stores one row per
column, and quantiles of any set of batches come from those rows alone.  A hot batch or
value costs no more than any other, as tasks send sketches, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.sources.io import write_stage

#: Items a sketch keeps; see ``rank_bound``.
K = 800


def rank_bound(k: int = K) -> float:
    """Rank error, as a share of the rows, that a quantile of a KLL sketch keeps to at 99 %.

    The published bound for two-sided rank error, 2.446 / k ** 0.9433, doubled: merging
    in any order keeps to it, and all quantiles are asked at once.
    """
    return 2 * 2.446 / k**0.9433


def sketch_batches(df: DataFrame, batch: str, columns: Sequence[str], k: int = K) -> DataFrame:
    """(batch, column, n, low, high, sketch) per batch and column; nulls and NaN are left out."""
    lines, sums = [], []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        v = F.when(~F.isnan(v), v)
        sums += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"), F.kll_sketch_agg_double(v, k).alias(f"s{i}")]
        lines.append(F.struct(F.lit(c).alias("column"), *[F.col(f"{x}{i}").alias(name) for x, name in zip("nlhs", ("n", "low", "high", "sketch"), strict=True)]))
    grouped = df.groupBy(F.col(f"`{batch}`").alias("batch")).agg(*sums)
    return grouped.select("batch", F.inline(F.array(*lines)))


def store_sketches(sketches: DataFrame, path: str) -> str:
    """Add the rows of new batches to the stored ones."""
    return write_stage(sketches, path, mode="append")


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float], k: int = K) -> DataFrame:
    """(column, p, n, value) from stored sketches; a column without values has none."""
    merged = sketches.filter("n > 0").groupBy("column").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )

    def value(p: float):  # the ends are known exactly
        return F.col("low") if p <= 0 else F.col("high") if p >= 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(p))

    lines = [F.struct(F.lit(p).alias("p"), F.col("n"), value(p).alias("value")) for p in map(float, probabilities)]
    return merged.select("column", F.inline(F.array(*lines)))
