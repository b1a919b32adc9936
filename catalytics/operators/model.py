"""Model training and evaluation.

Metrics are one aggregation per prediction frame (RMSE, MAE and R^2
together) instead of one job per metric; R^2 uses Spark's numerically
stable ``var_pop`` for the total sum of squares.
"""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.operators.features import vector_slot_names


def train_forest(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    num_trees: int = fixed.FOREST_TREES,
    seed: int = fixed.FOREST_SEED,
    **params,
) -> RandomForestRegressionModel:
    """M8: random-forest regressor (MLlib defaults: depth 5, 32 bins)."""
    rf = RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=num_trees, seed=seed, **params
    )
    return rf.fit(train)


def predict(model, df: DataFrame) -> DataFrame:
    """M9."""
    return model.transform(df)


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int | None = None
) -> DataFrame:
    """One row (n, rmse, mae, r2)."""
    err = F.col(f"`{prediction}`").cast("double") - F.col(f"`{label}`").cast("double")
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("sse"),
        F.var_pop(F.col(f"`{label}`").cast("double")).alias("vp"),
    )
    r2 = F.lit(1.0) - F.col("sse") / (F.col("vp") * F.col("n"))

    def rnd(c):
        return c if digits is None else F.round(c, digits)

    return stats.select(
        "n",
        rnd(F.sqrt("mse")).alias("rmse"),
        rnd(F.col("mae")).alias("mae"),
        rnd(r2).alias("r2"),
    )


def mean_of(df: DataFrame, column: str) -> float | None:
    """The global mean as a number (one aggregate row)."""
    return df.agg(F.avg(F.col(f"`{column}`").cast("double"))).first()[0]


def mean_baseline(
    train: DataFrame, test: DataFrame, label: str = "label", digits: int | None = None
) -> DataFrame:
    """Predict the train mean for every test row; score it.

    Result: (baseline_prediction, n, rmse, mae, r2).
    """
    m = mean_of(train, label)
    scored = test.withColumn("prediction", F.lit(m).cast("double"))
    mets = regression_metrics(scored, label, "prediction", digits)
    pred = F.lit(m).cast("double")
    pred = pred if digits is None else F.round(pred, digits)
    return mets.select(pred.alias("baseline_prediction"), *mets.columns)


def compare_models(model_metrics: DataFrame, baseline_metrics: DataFrame) -> DataFrame:
    """Per metric, model vs baseline and whether the model is better
    (RMSE and MAE lower, R^2 higher).  Inputs are one-row metric frames."""
    both = model_metrics.select(
        F.lit("model").alias("who"), "rmse", "mae", "r2"
    ).unionByName(baseline_metrics.select(F.lit("baseline").alias("who"), "rmse", "mae", "r2"))
    wide = both.agg(
        *[
            F.max(F.when(F.col("who") == w, F.col(m))).alias(f"{w}_{m}")
            for w in ("model", "baseline")
            for m in ("rmse", "mae", "r2")
        ]
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"model_{m}").alias("model"),
            F.col(f"baseline_{m}").alias("baseline"),
            (
                F.col(f"model_{m}") > F.col(f"baseline_{m}")
                if m == "r2"
                else F.col(f"model_{m}") < F.col(f"baseline_{m}")
            ).alias("model_better"),
        )
        for m in ("rmse", "mae", "r2")
    ]
    return wide.select(F.inline(F.array(*rows)))


def feature_importance(
    model, df: DataFrame, features: str = "features", numeric_names=None
) -> DataFrame:
    """(slot, name, importance) sorted by importance, names from metadata.

    The importance vector has one entry per feature slot and already lives
    on the driver inside the fitted model.  Slots that come out of the
    scaler carry no names in their metadata; ``numeric_names`` (the scaled
    inputs in order) names them.
    """
    names = vector_slot_names(df, features)
    if numeric_names:
        prefix = "numeric_features_scaled_"
        names = [
            numeric_names[int(n[len(prefix):])]
            if n.startswith(prefix) and n[len(prefix):].isdigit() and int(n[len(prefix):]) < len(numeric_names)
            else n
            for n in names
        ]
    imp = model.featureImportances.toArray().tolist()
    rows = [(i, names[i] if i < len(names) else f"slot_{i}", float(v)) for i, v in enumerate(imp)]
    out = df.sparkSession.createDataFrame(rows, "slot int, name string, importance double")
    return out.orderBy(F.desc("importance"), F.asc("slot"))
