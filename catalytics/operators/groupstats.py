"""Grouped and global statistics (A3-A10, A13, A14, D14-D18) and the named
questions built from them (Q1-Q7, R1, R2).

All grouping is ``groupBy().agg()`` with built-in aggregates, so Spark does a
partial aggregation in every task and shuffles one row per key per task: a
key holding a third of all rows costs no more shuffle than any other key.
Orderings end with the group key (nulls last) so ties resolve the same way
in every run and in the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.functions.buckets import bucketize, two_way
from catalytics.functions.parse import coerce_double, coerce_long
from catalytics.operators.quantiles import exact_quantiles, wide_quantiles
from catalytics.operators.topk import best_per_group, sort_by, top_k, top_k_with_position


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _mean(value: str, digits: int | None) -> Column:
    m = F.avg(_c(value))
    return m if digits is None else F.round(m, digits)


# ---------------------------------------------------------------- building blocks


def group_mean(
    df: DataFrame,
    keys: Sequence[str | Column],
    value: str,
    digits: int | None = 0,
    count_name: str = "total_apps",
    mean_name: str = "avg_installs",
) -> DataFrame:
    """A5: rows and (rounded) mean of ``value`` per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name), _mean(value, digits).alias(mean_name)
    )


def total_by(df: DataFrame, key: str, value: str, total_name: str = "total_installs") -> DataFrame:
    """A3: sum of a whole-number value per key (bigint)."""
    return df.groupBy(_c(key)).agg(F.sum(_c(value)).cast("long").alias(total_name))


def count_groups(df: DataFrame, key: str, name: str = "n_groups") -> DataFrame:
    """Number of non-null groups of ``key`` (one row)."""
    return df.agg(F.count_distinct(_c(key)).alias(name))


def bucket_stats(
    df: DataFrame,
    bucket: Column,
    value: str,
    bucket_name: str = "bucket",
    count_name: str = "app_count",
    mean_name: str = "avg_installs",
    digits: int | None = None,
) -> DataFrame:
    """A4: rows and mean per bucket, sorted by bucket label."""
    stats = df.groupBy(bucket.alias(bucket_name)).agg(
        F.count(F.lit(1)).alias(count_name), _mean(value, digits).alias(mean_name)
    )
    return sort_by(stats, [F.col(bucket_name).asc_nulls_last()])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """drop rows with a null (or NaN) in any of ``columns`` (all when None)."""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


# ---------------------------------------------------------------- named questions


def top_groups_by_mean(
    df: DataFrame, group: str, value: str, k: int = 10, digits: int = 0
) -> DataFrame:
    """Q1: the k groups with the highest rounded mean of ``value``."""
    stats = group_mean(df, [_c(group)], value, digits)
    return top_k(stats, [F.col("avg_installs").desc_nulls_last(), _c(group).asc_nulls_last()], k)


def mean_by_rounded_level(df: DataFrame, level: str, value: str, digits: int = 0) -> DataFrame:
    """Q2: mean of ``value`` per half-up rounded ``level``, highest level first."""
    stats = group_mean(
        df.where(_c(level).isNotNull()), [F.round(_c(level)).alias("rating_level")], value, digits
    )
    return sort_by(stats, [F.col("rating_level").desc_nulls_last()])


def top_groups_min_size(
    df: DataFrame, group: str, rating: str, min_count: int = 100, k: int = 10, digits: int = 2
) -> DataFrame:
    """Q3: top-k groups by mean rating among groups with at least ``min_count`` rows."""
    stats = group_mean(
        df.where(_c(rating).isNotNull()),
        [_c(group)],
        rating,
        digits,
        count_name="app_count",
        mean_name="avg_rating",
    ).where(F.col("app_count") >= min_count)
    order = [
        F.col("avg_rating").desc_nulls_last(),
        F.col("app_count").desc_nulls_last(),
        _c(group).asc_nulls_last(),
    ]
    return top_k(stats, order, k)


def mean_by_flag(
    df: DataFrame,
    price: str,
    value: str,
    digits: int = 2,
    labels: tuple[str, str] = (fixed.FREE_LABEL, fixed.PAID_LABEL),
) -> DataFrame:
    """Q4: free (price = 0) vs paid (anything else, null included)."""
    flag = two_way(_c(price) == 0, *labels).alias("app_type")
    stats = group_mean(df, [flag], value, digits)
    return sort_by(stats, [F.col("avg_installs").desc_nulls_last(), F.col("app_type")])


def mean_by_band(
    df: DataFrame,
    age: str,
    value: str,
    edges: Sequence[float] = tuple(fixed.AGE_BAND_EDGES),
    labels: Sequence[str] = tuple(fixed.AGE_BAND_LABELS),
    digits: int = 0,
) -> DataFrame:
    """Q5: mean of ``value`` per age band (null ages removed first)."""
    band = bucketize(_c(age), edges, labels).alias("app_age_group")
    stats = group_mean(df.where(_c(age).isNotNull()), [band], value, digits)
    return sort_by(stats, [F.col("avg_installs").desc_nulls_last(), F.col("app_age_group")])


def best_subgroup_per_group(
    df: DataFrame, group: str, sub: str, value: str, k: int = 15, digits: int = 0
) -> DataFrame:
    """Q6: inside each group, the subgroup with the highest rounded mean; top k groups."""
    stats = group_mean(df.where(_c(sub).isNotNull()), [_c(group), _c(sub)], value, digits)
    best = best_per_group(
        stats, [group], [F.col("avg_installs").desc_nulls_last(), _c(sub).asc_nulls_last()]
    )
    return top_k(best, [F.col("avg_installs").desc_nulls_last(), _c(group).asc_nulls_last()], k)


def numeric_summary(
    df: DataFrame,
    category: str,
    price: str,
    installs: str,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Q7: one-row summary of price and installs.

    Count, distinct categories, rounded means and sample variances come from
    one aggregation.  Percentiles are exact (distributed, see
    ``operators.quantiles``) when ``exact``; otherwise the bounded
    ``percentile_approx`` sketch with ``accuracy``.  The two one-row results
    are merged by union + max, not by a join.
    """
    base = df.where(_c(price).isNotNull() & _c(installs).isNotNull())
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    stats = [
        F.count(F.lit(1)).alias("total_apps"),
        F.count_distinct(_c(category)).alias("distinct_categories"),
        F.round(F.avg(_c(price)), 2).alias("avg_price"),
        F.round(F.var_samp(_c(price)), 2).alias("price_variance"),
        F.round(F.avg(_c(installs)), 2).alias("avg_installs"),
        F.round(F.var_samp(_c(installs)), 2).alias("installs_variance"),
    ]
    pct = {
        (price, 0.5): "median_price",
        (installs, 0.25): "installs_p25",
        (installs, 0.5): "median_installs",
        (installs, 0.75): "installs_p75",
    }
    pct_types = {alias: types[col] for (col, _), alias in pct.items()}
    if not exact:
        approx = [
            F.percentile_approx(_c(col), p, accuracy).alias(alias) for (col, p), alias in pct.items()
        ]
        return base.agg(*stats, *approx)
    summary = base.agg(*stats)
    quant = wide_quantiles(
        exact_quantiles(base, [price, installs], [0.25, 0.5, 0.75]), pct, pct_types
    )
    merged = summary.unionByName(quant, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in summary.columns + quant.columns])


def _rdd_style_input(df: DataFrame, group: str, rating: str | None, value: str) -> DataFrame:
    cols = [group] + ([rating] if rating else []) + [value]
    return drop_incomplete(df.select(*[_c(c) for c in cols]))


def top_groups_by_total(
    df: DataFrame, group: str, value: str, k: int = 10, rating: str | None = None
) -> DataFrame:
    """Top-k groups by total of ``value`` coerced to a whole number, with position.

    Rows with a null in the analysed columns are dropped first; the value is
    coerced like the row-wise original (integers kept, fractions truncated).
    """
    base = _rdd_style_input(df, group, rating, value)
    dtype = base.schema[value].dataType
    pairs = base.select(_c(group), coerce_long(_c(value), dtype, 0).alias("_v"))
    totals = total_by(pairs, group, "_v")
    return top_k_with_position(
        totals, [F.col("total_installs").desc_nulls_last(), _c(group).asc_nulls_last()], k
    )


def rating_bucket_stats(
    df: DataFrame,
    group: str,
    rating: str,
    value: str,
    edges: Sequence[float] = tuple(fixed.RATING_BUCKET_EDGES),
    labels: Sequence[str] = tuple(fixed.RATING_BUCKET_LABELS),
    bounds: tuple[float, float] = fixed.RATING_RANGE,
    digits: int | None = None,
) -> DataFrame:
    """R2: closed-range filter on the rating, floor buckets, rows and mean per bucket."""
    base = _rdd_style_input(df, group, rating, value)
    rtype = base.schema[rating].dataType
    vtype = base.schema[value].dataType
    typed = base.select(
        coerce_double(_c(rating), rtype, -1.0).alias("_r"),
        coerce_long(_c(value), vtype, 0).alias("_v"),
    ).where(F.col("_r").between(bounds[0], bounds[1]))
    return bucket_stats(typed, bucketize("_r", edges, labels), "_v", digits=digits)
