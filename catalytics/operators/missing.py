"""Missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics import fixed
from catalytics.functions.parse import replace_sentinel as _sentinel_expr
from catalytics.operators.quantiles import quantile_values


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Per-column constants for nulls.

    A text constant is only applied to a text column (and a number only to
    a numeric column): filling 'Unknown' into a number would fail with ANSI
    on and do nothing with ANSI off, so it is skipped in both modes.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    usable = {}
    for c, v in values.items():
        t = types.get(c)
        if t is None:
            continue
        if isinstance(v, str) and isinstance(t, T.StringType):
            usable[c] = v
        elif isinstance(v, bool) and isinstance(t, T.BooleanType):
            usable[c] = v
        elif isinstance(v, (int, float)) and not isinstance(v, bool) and isinstance(t, T.NumericType):
            usable[c] = v
    return df.na.fill(usable) if usable else df


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column (distributed; see operators.quantiles)."""
    got = quantile_values(df, columns, [0.5], 0.0)
    return {c: v[0] for c, v in got.items()}


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls (and NaN) with the exact median of the rows given.

    The medians are one number per column, computed by a distributed job and
    baked into the plan as literals.  A column with no values keeps its
    nulls (there is no median to use).
    """
    medians = {c: m for c, m in column_medians(df, columns).items() if m is not None}
    return df.na.fill(medians) if medians else df


def replace_sentinel(
    df: DataFrame,
    column: str,
    sentinel: str = fixed.CURRENCY_SENTINEL,
    default: str = fixed.CURRENCY_DEFAULT,
) -> DataFrame:
    """Null or ``sentinel`` -> ``default`` in ``column``."""
    return df.withColumn(column, _sentinel_expr(F.col(f"`{column}`"), sentinel, default))


def impute_median(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = fixed.IMPUTED_SUFFIX,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """N4 (exact form): ``<col><suffix>`` = col with nulls/NaN replaced by the
    exact median of ``fit_on`` (default: ``df``), as double.

    The MLlib ``Imputer`` used inside the ML pipeline approximates the median
    with a bounded sketch; this operator is the exact, still distributed,
    variant.
    """
    return impute_with(df, column_medians(fit_on if fit_on is not None else df, columns), suffix)


def impute_with(df: DataFrame, medians: dict, suffix: str = fixed.IMPUTED_SUFFIX) -> DataFrame:
    """``<col><suffix>`` for every column of ``medians``, as double; a column whose
    median is None (no values) keeps its nulls."""
    out = {}
    for c, m in medians.items():
        v = F.col(f"`{c}`").cast("double")
        filled = v if m is None else F.when(v.isNull() | F.isnan(v), F.lit(float(m))).otherwise(v)
        out[f"{c}{suffix}"] = filled
    return df.withColumns(out)
