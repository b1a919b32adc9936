"""Invariants the source's golden outputs satisfy, checked on driver tables."""

from pyspark.sql import functions as F

from catalytics.operators import groupstats as G
from catalytics.plans import bindings as B
from tests.conftest import SF_CHECK


def test_level_band_flag_counts_sum_to_rows(spark):
    part = spark.read.parquet(f"{SF_CHECK}/part.parquet")
    n_part = part.count()
    assert sum(r["total_apps"] for r in B.q_mean_by_rounded_level(spark, SF_CHECK).collect()) == n_part
    assert sum(r["app_count"] for r in B.q_rating_bucket_stats(spark, SF_CHECK).collect()) == n_part
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    assert sum(r["total_apps"] for r in B.q_mean_by_flag(spark, SF_CHECK).collect()) == li.count()
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    assert sum(r["total_apps"] for r in B.q_mean_by_band(spark, SF_CHECK).collect()) == orders.count()


def test_weighted_flag_mean_equals_global_mean(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    stats = G.group_mean(li, [F.when(F.col("l_tax") == 0, "Free").otherwise("Paid")], "l_extendedprice", None)
    rows = stats.collect()
    weighted = sum(r["total_apps"] * r["avg_installs"] for r in rows) / sum(r["total_apps"] for r in rows)
    overall = li.agg(F.avg("l_extendedprice")).first()[0]
    assert abs(weighted - overall) < 1e-6 * overall


def test_one_hot_width_is_labels_plus_one(spark):
    rows = B.q_one_hot(spark, SF_CHECK).collect()
    assert all(len(r["type_ohe"]) == len(rows) + 1 for r in rows)


def test_r2_identity_with_baseline(spark):
    # R^2 of a model = 1 - (RMSE_model / RMSE_mean)^2 when the mean is the test mean
    from catalytics.operators.model import regression_metrics

    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"),
    )
    m = regression_metrics(li).first()
    mean = li.agg(F.avg("label")).first()[0]
    b = regression_metrics(li.withColumn("prediction", F.lit(mean))).first()
    assert abs(m["r2"] - (1 - (m["rmse"] / b["rmse"]) ** 2)) < 1e-9
    assert abs(b["r2"]) < 1e-9


def test_hot_group_matches_pandas(spark):
    """One category holds a third of all rows: grouped answers stay exact."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n = 9000
    cat = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    sub = rng.choice(["x", "y", "z"], n)
    val = rng.integers(0, 10_000, n).astype(float)
    pdf = pd.DataFrame({"cat": cat, "sub": sub, "val": val})
    df = spark.createDataFrame(pdf).repartition(6)

    got = {r["cat"]: (r["total_apps"], r["avg_installs"]) for r in G.top_groups_by_mean(df, "cat", "val", k=10, digits=2).collect()}
    exp = pdf.groupby("cat")["val"].agg(["count", "mean"])
    assert got == {c: (int(r["count"]), round(r["mean"], 2)) for c, r in exp.iterrows()}

    totals = {r["cat"]: r["total_installs"] for r in G.top_groups_by_total(df, "cat", "val").collect()}
    assert totals == {c: int(v) for c, v in pdf.groupby("cat")["val"].sum().items()}

    best = {r["cat"]: r["sub"] for r in G.best_subgroup_per_group(df, "cat", "sub", "val", digits=None).collect()}
    means = pdf.groupby(["cat", "sub"])["val"].mean().reset_index()
    exp_best = means.sort_values(["cat", "val", "sub"], ascending=[True, False, True]).groupby("cat").head(1)
    assert best == dict(zip(exp_best["cat"], exp_best["sub"]))


def test_summary_approx_path_equals_exact_on_small_data(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").limit(500)
    li = spark.createDataFrame(li.toPandas())  # a fixed 500-row frame
    exact = G.numeric_summary(li, "l_returnflag", "l_tax", "l_extendedprice").first().asDict()
    approx = G.numeric_summary(li, "l_returnflag", "l_tax", "l_extendedprice", exact=False, accuracy=100000).first().asDict()
    assert exact == approx
