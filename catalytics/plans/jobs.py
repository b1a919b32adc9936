"""End-to-end jobs (E1-E5) composed from the operators.

Ordering matters and is kept: typing -> row rules -> size in KB -> exact
median fill (over the rows that passed the rules, before the identifier
filter) -> text fills -> currency -> identifiers.  Reports are computed from
the cleaned table but never change it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.functions import parse as P
from catalytics.operators import features as FE
from catalytics.operators import model as M
from catalytics.operators.missing import column_medians, fill_constants, fill_median, impute_with, replace_sentinel
from catalytics.operators.reports import StageLog, duplicate_key_count, outlier_report, stage_report
from catalytics.operators.rules import catalogue_rules, enforce_rules, require_present, rule_report
from catalytics.operators.split import label_split
from catalytics.session import COMPILED, settings
from catalytics.sources.io import cut_lineage, save_model


def _c(name: str):
    return F.col(f"`{name}`")


def type_catalogue(raw: DataFrame) -> DataFrame:
    """Raw text columns -> typed columns, one projection."""
    typed = raw.withColumns(
        {
            "Installs": P.parse_count(_c("Installs"), fixed.COUNT_STRIP_CHARS),
            "Minimum Installs": P.parse_count(_c("Minimum Installs"), fixed.COMMA_STRIP_CHARS),
            "Maximum Installs": P.parse_count(_c("Maximum Installs"), fixed.COMMA_STRIP_CHARS),
            "Price": P.parse_price(_c("Price")),
            "Rating": P.parse_double(_c("Rating")),
            "Rating Count": P.parse_count(_c("Rating Count"), None),
            "Released": P.parse_date(_c("Released")),
            "Last Updated": P.parse_date(_c("Last Updated")),
            "Scraped Time": P.parse_timestamp(_c("Scraped Time")),
            "Ad Supported": P.parse_flag(_c("Ad Supported")),
            "In App Purchases": P.parse_flag(_c("In App Purchases")),
            "Editors Choice": P.parse_flag(_c("Editors Choice")),
        }
    )
    return typed.withColumn("Free", P.free_flag(_c("Price")))


def validated_catalogue(raw: DataFrame) -> DataFrame:
    """Typed rows that pass F1-F4, with ``Size_KB`` added (before any fill)."""
    kept = enforce_rules(type_catalogue(raw), catalogue_rules())
    return kept.withColumn("Size_KB", P.parse_size_kb(_c("Size")))


def clean_catalogue(raw: DataFrame, stage: bool = True) -> DataFrame:
    """Raw text catalogue -> typed, validated, imputed table.

    The median of ``Size_KB`` must be taken over the rows that passed the
    rules, before the identifier filter, so it needs its own jobs.  With
    ``stage`` the validated rows are written once under
    ``spark.checkpoint.dir``: the median's scans then read one Parquet column
    and the returned plan reads typed Parquet, instead of parsing the raw
    text three times.
    """
    valid = validated_catalogue(raw)
    if stage:
        with settings(raw.sparkSession, COMPILED):
            valid = cut_lineage(valid, "validated")
    filled = fill_median(valid, ["Size_KB"])
    filled = fill_constants(filled, fixed.TEXT_FILLS)
    filled = replace_sentinel(filled, "Currency")
    return require_present(filled, fixed.REQUIRED_COLUMNS)


@dataclass
class CleaningReports:
    rules: DataFrame
    outliers: DataFrame
    duplicates: DataFrame
    shape: DataFrame


def cleaning_reports(
    raw: DataFrame,
    cleaned: DataFrame,
    outlier_columns=tuple(fixed.OUTLIER_COLUMNS),
    relative_error: float = fixed.OUTLIER_QUANTILE_ERROR,
) -> CleaningReports:
    """Rows lost per rule, IQR outliers, duplicate ids, and row/column counts."""
    return CleaningReports(
        rules=rule_report(type_catalogue(raw), catalogue_rules()),
        outliers=outlier_report(cleaned, list(outlier_columns), relative_error=relative_error),
        duplicates=duplicate_key_count(cleaned, "App Id"),
        shape=stage_report({"raw": raw, "cleaned": cleaned}),
    )


def reduce_columns(df: DataFrame, drop=tuple(fixed.REDUCTION_DROP)) -> DataFrame:
    """Drop leakage, identifier and free-text columns."""
    return FE.drop_columns(df, list(drop))


def build_features(
    reduced: DataFrame,
    as_of: str | _dt.date = fixed.REFERENCE_DAY,
    numeric=tuple(fixed.ANALYSIS_NUMERIC),
    weekend_null_as: int | None = 0,
) -> tuple[DataFrame, object]:
    """Features + encoders fitted on the full table -> (transformed, model).

    The older form has ``fixed.EARLY_NUMERIC``, today as reference day and keeps a
    missing weekend flag (``weekend_null_as=None``).
    """
    tdf = FE.catalogue_features(reduced, as_of, weekend_null_as)
    pipe = FE.feature_pipeline(list(numeric), FE.CATALOGUE_CATEGORICAL, impute=False)
    model, out = FE.fit_transform(pipe, tdf, tdf)
    return FE.select_columns(out, fixed.TRANSFORMED_COLUMNS), model


ML_BASE_COLUMNS = ["label", "Category", "Content Rating", *fixed.ML_NUMERIC]


def ml_base(featured: DataFrame, keep=()) -> DataFrame:
    """P3 + F6: label and 13 inputs as double; label and categoricals required.

    ``keep`` carries extra columns (for example a split key) through.
    """
    cols = [_c(k) for k in keep]
    cols += [_c("Maximum Installs").cast("double").alias("label"), _c("Category"), _c("Content Rating")]
    cols += [_c(c).cast("double").alias(c) for c in fixed.ML_NUMERIC]
    return require_present(featured.select(*cols), ["label", "Category", "Content Rating"])


def prepare_ml(
    featured: DataFrame,
    split_key: str | None = None,
    imputer_relative_error: float = 0.001,
    materialize_split: bool = True,
    exact_median: bool = False,
) -> tuple[DataFrame, DataFrame, object]:
    """Base -> 70/30 split -> pipeline fitted on train only -> (train, test, model).

    Every row is labelled once, by ``split_key`` (rows sharing a key stay on one
    side) or else by a hash of its own values, so the two sides never depend on
    how the input is partitioned.  With ``materialize_split`` the labelled rows
    are written once under ``spark.checkpoint.dir`` and both sides are filters
    of that table: the estimator fits scan it instead of re-running the
    featurization, and no row can change sides in between.  With
    ``exact_median`` the missing numbers get the exact medians of the train
    rows before the pipeline, which then has no imputing stage.
    """
    carried = [split_key] if split_key and split_key not in ML_BASE_COLUMNS else []
    base = ml_base(featured, keep=carried)
    key = split_key or "_row_hash"
    if not split_key:
        base = base.withColumn(key, F.xxhash64(*[_c(c) for c in base.columns]))
    labelled = label_split(base, key, name="_side")
    if key not in ML_BASE_COLUMNS:
        labelled = labelled.drop(key)
    if materialize_split:
        with settings(featured.sparkSession, COMPILED):
            labelled = cut_lineage(labelled, "ml-base")
    train, test = (labelled.where(F.col("_side") == side).drop("_side") for side in ("train", "test"))
    numeric = fixed.ML_NUMERIC
    if exact_median:
        medians = column_medians(train, fixed.ML_NUMERIC)
        train, test = (impute_with(side, medians) for side in (train, test))
        numeric = [f"{c}{fixed.IMPUTED_SUFFIX}" for c in fixed.ML_NUMERIC]
    pipe = FE.feature_pipeline(
        numeric,
        FE.CATALOGUE_CATEGORICAL,
        impute=not exact_median,
        imputer_relative_error=imputer_relative_error,
    )
    model, tr, te = FE.fit_transform(pipe, train, train, test)
    return (
        FE.select_columns(tr, fixed.ML_PREPARED_COLUMNS),
        FE.select_columns(te, fixed.ML_PREPARED_COLUMNS),
        model,
    )


@dataclass
class Evaluation:
    model: object
    train_metrics: DataFrame
    test_metrics: DataFrame
    baseline: DataFrame
    comparison: DataFrame
    importances: DataFrame


def train_and_evaluate(
    train: DataFrame, test: DataFrame, model_dir: str | None = None, **forest_params
) -> Evaluation:
    """E5: forest -> [save] -> predictions -> metrics, mean baseline, verdicts, importances."""
    forest = M.train_forest(train, **forest_params)
    if model_dir:
        save_model(forest, model_dir)
    train_m = M.regression_metrics(M.predict(forest, train))
    test_m = M.regression_metrics(M.predict(forest, test))
    base = M.mean_baseline(train, test)
    return Evaluation(
        model=forest,
        train_metrics=train_m,
        test_metrics=test_m,
        baseline=base,
        comparison=M.compare_models(test_m, base),
        importances=M.feature_importance(forest, train),
    )


def run_catalogue_pipeline(raw: DataFrame, out_dir: str, as_of: str = fixed.REFERENCE_DAY) -> dict:
    """Whole flow with Parquet hand-overs: cleaned -> transformed -> train/test.

    Rows and missing values of every stage are counted by the jobs that write them and
    are in ``log``; no stage is read again to be counted.
    """
    log = StageLog(raw.sparkSession)
    cleaned = log.write("cleaned", clean_catalogue(raw))
    reduced = reduce_columns(cleaned)
    transformed, _ = build_features(reduced, as_of)
    log.write("transformed", transformed, f"{out_dir}/transformed")
    featured = FE.catalogue_features(reduced, as_of)
    train, test, _ = prepare_ml(featured)
    log.write("train", train, f"{out_dir}/ml/train")
    log.write("test", test, f"{out_dir}/ml/test")
    return {"cleaned": cleaned, "transformed": f"{out_dir}/transformed", "log": log}
