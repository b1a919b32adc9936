"""Splits, metrics and the ML pipeline on the fixture and driver tables."""

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from catalytics.operators.model import compare_models, regression_metrics
from catalytics.operators.split import label_split, split_by_key, split_random
from tests.conftest import SF_CHECK


def test_splits_keep_every_row(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    n = orders.count()
    train, test = split_random(orders)
    assert train.count() + test.count() == n
    ktrain, ktest = split_by_key(orders, "o_orderkey")
    assert ktrain.count() + ktest.count() == n
    assert ktrain.join(ktest, "o_orderkey").count() == 0
    frac = ktrain.count() / n
    assert 0.65 < frac < 0.75
    # the same key always lands on the same side
    a = label_split(orders, "o_orderkey").select("o_orderkey", "split")
    b = label_split(orders.repartition(3), "o_orderkey").select("o_orderkey", F.col("split").alias("s2"))
    assert a.join(b, "o_orderkey").where(F.col("split") != F.col("s2")).count() == 0


def test_metrics_equal_mllib_evaluator(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_quantity")).alias("prediction"),
    )
    m = regression_metrics(li).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(metricName=name).evaluate(li)
        assert abs(m[name] - ev) <= 1e-9 * max(1.0, abs(ev)), name


def test_compare_models_verdicts(spark):
    a = spark.createDataFrame([(1.0, 1.0, 0.5)], "rmse double, mae double, r2 double")
    b = spark.createDataFrame([(2.0, 0.5, 0.1)], "rmse double, mae double, r2 double")
    got = {r["metric"]: r["model_better"] for r in compare_models(a, b).collect()}
    assert got == {"rmse": True, "mae": False, "r2": True}


def test_pipeline_on_fixture(raw):
    from catalytics import fixed
    from catalytics.operators.features import catalogue_features, vector_width
    from catalytics.plans import jobs

    feat = catalogue_features(jobs.reduce_columns(jobs.clean_catalogue(raw)))
    transformed, _ = jobs.build_features(jobs.reduce_columns(jobs.clean_catalogue(raw)))
    assert transformed.columns == fixed.TRANSFORMED_COLUMNS
    # 3 categories + unseen slot; 3 content ratings + unseen slot
    assert vector_width(transformed, "category_ohe") == 4
    assert vector_width(transformed, "content_rating_ohe") == 4
    assert vector_width(transformed, "features") == 8 + 4 + 4
    train, test, _ = jobs.prepare_ml(feat, split_key="Category")
    assert train.columns == fixed.ML_PREPARED_COLUMNS
    assert train.count() + test.count() == 9


def test_pipeline_is_fitted_on_train_only(spark):
    """Categories that only occur in test rows get the indexer's unseen slot."""
    from catalytics.operators.features import catalogue_features
    from catalytics.plans import jobs
    from catalytics.plans.stages import staged_cleaned_catalogue
    from tests.conftest import SF_SMALL

    feat = catalogue_features(jobs.reduce_columns(staged_cleaned_catalogue(spark, SF_SMALL)))
    train, test, _ = jobs.prepare_ml(feat, split_key="Category")
    train_cats = {r[0] for r in train.select("Category").distinct().collect()}
    test_rows = test.select("Category", "category_index").distinct().collect()
    assert train_cats and test_rows
    for cat, idx in test_rows:
        assert cat not in train_cats  # the key split keeps a category on one side
        assert idx == float(len(train_cats))  # unseen by the train-fitted indexer


def test_indexer_refuses_too_many_categories(spark):
    import pytest

    from catalytics.operators.features import require_few_categories

    df = spark.range(500).selectExpr("cast(id as string) as c")
    require_few_categories(df, ["c"], limit=1000)
    with pytest.raises(ValueError, match="categories"):
        require_few_categories(df, ["c"], limit=100)
