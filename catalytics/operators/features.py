"""Projections and feature engineering (P2-P6, D6-D13 wiring, M1-M7).

Encoders are MLlib estimators: fitting a ``StringIndexer`` is one grouped
count per column (labels stay on the driver, bounded by the number of
categories); ``MinMaxScaler`` fits one min/max summary.  ``transform`` is a
row-local projection, so applying a fitted pipeline never shuffles.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, Imputer, MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.functions.dates import days_since, weekend_flag
from catalytics.functions.parse import flag_to_number, parse_version


def _c(name: str):
    return F.col(f"`{name}`")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in the given order."""
    return df.select(*[_c(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5: drop ``columns``; names the frame does not have are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def date_features(
    df: DataFrame,
    released: str,
    updated: str,
    as_of: str | _dt.date,
    weekend_null_as: int | None = 0,
) -> DataFrame:
    """Days since update, age in days, weekend-update flag (one Project)."""
    return df.withColumns(
        {
            "days_since_update": days_since(_c(updated), as_of),
            "app_age_days": days_since(_c(released), as_of),
            "is_weekend_update": weekend_flag(_c(updated), weekend_null_as),
        }
    )


def catalogue_features(
    df: DataFrame, as_of: str | _dt.date = fixed.REFERENCE_DAY, weekend_null_as: int | None = 0
) -> DataFrame:
    """D6-D8, D10, D13 on a cleaned, reduced catalogue."""
    df = df.withColumn("min_android_version", parse_version(_c("Minimum Android")))
    df = date_features(df, "Released", "Last Updated", as_of, weekend_null_as)
    return df.withColumns(
        {
            "ad_supported_num": flag_to_number(_c("Ad Supported")),
            "in_app_purchases_num": flag_to_number(_c("In App Purchases")),
            "editors_choice_num": flag_to_number(_c("Editors Choice")),
        }
    )


#: Most categories an indexer may have: its labels live on the driver.
MAX_CATEGORIES = 100_000


def require_few_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> None:
    """Fail clearly before labels of a high-cardinality column reach the driver
    (one aggregation; distinct values are estimated within a few percent)."""
    row = df.agg(*[F.approx_count_distinct(_c(c)).alias(c) for c in columns]).first()
    for c in columns:
        if row[c] > limit:
            raise ValueError(f"column {c!r} has about {row[c]} categories; an indexer takes at most {limit}")


#: Slots of a hashed category column.
HASHED_WIDTH = 1024


def hashed_categories(df: DataFrame, columns: Sequence[str], width: int = HASHED_WIDTH, suffix: str = "_hashed") -> DataFrame:
    """M1/M2 for columns of any number of categories: ``<column>_hashed``, a one-hot vector.

    The slot is a hash of column and value, so nothing is fitted, no labels reach the
    driver and the width is fixed; two categories may share a slot (``hash_collisions``).
    A missing value has no slot set.
    """
    for c in columns:
        df = FeatureHasher(inputCols=[c], outputCol=f"{c}{suffix}", numFeatures=width, categoricalCols=[c]).transform(df)
    return df


def hash_collisions(df: DataFrame, columns: Sequence[str], width: int = HASHED_WIDTH) -> DataFrame:
    """(column, n_categories, n_slots, n_shared, most) per column: categories, slots in use,
    categories that share their slot, and the fullest slot's number of categories.

    Distinct values are found by an aggregation with map-side combine and meet by slot.
    """
    out = []
    for c in columns:
        values = df.filter(_c(c).isNotNull()).select(_c(c)).distinct()
        slots = hashed_categories(values, [c], width).select(F.array_position(vector_to_array(f"`{c}_hashed`"), F.lit(1.0)).alias("slot"))
        counted = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
        out.append(
            counted.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_categories"),
                F.count(F.lit(1)).alias("n_slots"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_shared"),
                F.coalesce(F.max("n"), F.lit(0)).alias("most"),
            ).select(F.lit(c).alias("column"), "*")
        )
    return reduce(DataFrame.unionByName, out)


def index_categories(df: DataFrame, column: str, output: str) -> tuple[DataFrame, list[str]]:
    """M1: frequency index (ties alphabetical); null/unseen -> the next index."""
    require_few_categories(df, [column])
    model = StringIndexer(
        inputCol=column, outputCol=output, handleInvalid="keep", stringOrderType="frequencyDesc"
    ).fit(df)
    return model.transform(df), list(model.labels)


def min_max_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """M4 in column form: (x - min) / (max - min); a constant column gives 0.5.

    min and max are one aggregation (two numbers per column) used as
    literals, like a fitted scaler; NaN is left out of min/max and passes
    through.
    """
    aggs = []
    for c in columns:
        v = F.when(~F.isnan(_c(c).cast("double")), _c(c).cast("double"))
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c in columns:
        lo, hi = row[f"min_{c}"], row[f"max_{c}"]
        x = _c(c).cast("double")
        if lo is None:
            out[f"{c}{suffix}"] = x
        elif hi == lo:
            out[f"{c}{suffix}"] = F.when(x.isNull(), x).when(F.isnan(x), x).otherwise(F.lit(0.5))
        else:
            out[f"{c}{suffix}"] = (x - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumns(out)


def feature_pipeline(
    numeric: Sequence[str],
    categorical: Sequence[tuple[str, str, str]],
    impute: bool = False,
    imputer_relative_error: float = 0.001,
    hashed: Sequence[str] = (),
    hashed_width: int = HASHED_WIDTH,
) -> Pipeline:
    """M6: [Imputer] -> StringIndexers -> OneHotEncoder -> [hashers] -> assembler -> MinMaxScaler -> assembler.

    ``categorical`` is a list of (input, index column, one-hot column).  ``hashed`` names
    columns with more categories than an indexer may have: each is a one-hot vector of
    ``hashed_width`` slots by hash, after the others in ``features``.
    With ``impute`` the numeric inputs are median-imputed first into
    ``<col>_imp`` (MLlib's bounded-sketch median).
    """
    stages = []
    num_inputs = list(numeric)
    if impute:
        num_inputs = [f"{c}{fixed.IMPUTED_SUFFIX}" for c in numeric]
        stages.append(
            Imputer(
                strategy="median",
                inputCols=list(numeric),
                outputCols=num_inputs,
                relativeError=imputer_relative_error,
            )
        )
    # one indexer for all categorical columns: their label counts come from a
    # single aggregation job instead of one job per column
    stages.append(
        StringIndexer(
            inputCols=[src for src, _, _ in categorical],
            outputCols=[idx for _, idx, _ in categorical],
            handleInvalid="keep",
            stringOrderType="frequencyDesc",
        )
    )
    stages.append(
        OneHotEncoder(
            inputCols=[idx for _, idx, _ in categorical],
            outputCols=[ohe for _, _, ohe in categorical],
            handleInvalid="keep",
        )
    )
    for c in hashed:
        stages.append(FeatureHasher(inputCols=[c], outputCol=f"{c}_hashed", numFeatures=hashed_width, categoricalCols=[c]))
    stages.append(
        VectorAssembler(inputCols=num_inputs, outputCol="numeric_features", handleInvalid="keep")
    )
    stages.append(MinMaxScaler(inputCol="numeric_features", outputCol="numeric_features_scaled"))
    stages.append(
        VectorAssembler(
            inputCols=["numeric_features_scaled", *[ohe for _, _, ohe in categorical], *[f"{c}_hashed" for c in hashed]],
            outputCol="features",
            handleInvalid="keep",
        )
    )
    return Pipeline(stages=stages)


CATALOGUE_CATEGORICAL = [
    ("Category", "category_index", "category_ohe"),
    ("Content Rating", "content_rating_index", "content_rating_ohe"),
]


def fit_transform(pipeline: Pipeline, fit_on: DataFrame, *apply_to: DataFrame):
    """Fit on one frame, transform the others: (model, transformed...)."""
    for stage in pipeline.getStages():
        if isinstance(stage, StringIndexer):
            require_few_categories(fit_on, stage.getInputCols())
    model: PipelineModel = pipeline.fit(fit_on)
    return (model, *[model.transform(d) for d in apply_to])


def vector_width(df: DataFrame, column: str) -> int:
    """M7: vector size from the column's ML attribute metadata (no job)."""
    meta = df.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    return sum(len(v) for v in attrs.values())


def vector_slot_names(df: DataFrame, column: str) -> list[str]:
    """Names of the slots of an assembled vector, from its metadata."""
    meta = df.schema[column].metadata.get("ml_attr", {})
    slots = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            slots[int(a["idx"])] = a.get("name", f"slot_{a['idx']}")
    return [slots.get(i, f"slot_{i}") for i in range(vector_width(df, column))]


def vectors_as_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vectors leaving MLlib become array<double> (comparable, Parquet-friendly)."""
    return df.withColumns({c: vector_to_array(_c(c)) for c in columns})
