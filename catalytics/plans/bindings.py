"""Binding of every operator to the driver's tables.

The catalogue the operators were designed for is not available, so each
registered query runs an operator over whole driver tables (or text that
Spark derives from them), with these stand-ins:

    group / category   p_brand, o_custkey, l_returnflag
    subgroup           p_type
    metric (installs)  p_retailprice, o_totalprice, l_extendedprice
    rating 0-5         p_size / 10.0
    price (0 = free)   l_tax
    released/updated   o_orderdate, l_shipdate

Each function takes (spark, sf_dir) and returns a DataFrame; staged tables, fitted
encoders and medians are computed while it is being built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.functions import parse as P
from catalytics.functions.dates import days_since, weekend_flag
from catalytics.operators import features as FE
from catalytics.operators import groupstats as G
from catalytics.operators import model as M
from catalytics.operators import reports as R
from catalytics.operators.missing import fill_constants, fill_median, impute_median, replace_sentinel
from catalytics.operators.quantiles import quantile_values, rank_check
from catalytics.operators.rules import catalogue_rules, enforce_rules, rule_report
from catalytics.operators.split import label_split, split_by_key, split_random
from catalytics.operators.topk import preview
from catalytics.plans import jobs
from catalytics.plans.stages import (
    raw_source,
    staged_cleaned_catalogue,
    staged_ml_sets,
    staged_raw_catalogue,
)
from catalytics.sources.io import (
    load_model,
    read_raw_csv,
    read_table,
    save_model,
    scratch_path,
    sql_query,
    write_csv,
)

# Reference day for the orders binding: one day after the last order date,
# so all four age bands are populated.
ORDERS_AS_OF = "2001-08-02"
MIN_GROUP_SIZE = 75


def _part_with_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.withColumn("rating", F.col("p_size") / F.lit(10.0))


def q_top_groups_by_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.top_groups_by_mean(read_table(spark, sf_dir, "part"), "p_brand", "p_retailprice")


def q_mean_by_rounded_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.mean_by_rounded_level(_part_with_rating(spark, sf_dir), "rating", "p_retailprice")


def q_top_groups_min_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.top_groups_min_size(
        _part_with_rating(spark, sf_dir), "p_brand", "rating", min_count=MIN_GROUP_SIZE
    )


def q_mean_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.mean_by_flag(read_table(spark, sf_dir, "lineitem"), "l_tax", "l_extendedprice")


def q_mean_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumn(
        "app_age_days", days_since(F.to_date("o_orderdate"), ORDERS_AS_OF)
    )
    return G.mean_by_band(orders, "app_age_days", "o_totalprice")


def q_best_subgroup_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.best_subgroup_per_group(
        read_table(spark, sf_dir, "part"), "p_brand", "p_type", "p_retailprice"
    )


def q_numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.numeric_summary(
        read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_tax", "l_extendedprice"
    )


def q_top_groups_by_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.top_groups_by_total(read_table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")


def q_category_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return G.count_groups(G.drop_incomplete(orders.select("o_custkey", "o_totalprice")), "o_custkey")


def q_rating_bucket_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.rating_bucket_stats(
        _part_with_rating(spark, sf_dir), "p_brand", "rating", "p_retailprice", digits=2
    )


QUERIES = {
    "top_groups_by_mean": q_top_groups_by_mean,
    "mean_by_rounded_level": q_mean_by_rounded_level,
    "top_groups_min_size": q_top_groups_min_size,
    "mean_by_flag": q_mean_by_flag,
    "mean_by_band": q_mean_by_band,
    "best_subgroup_per_group": q_best_subgroup_per_group,
    "numeric_summary": q_numeric_summary,
    "top_groups_by_total": q_top_groups_by_total,
    "category_group_count": q_category_group_count,
    "rating_bucket_stats": q_rating_bucket_stats,
}


# ------------------------------------------------------------------ catalogue jobs


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + sink: the derived catalogue written as CSV text, read back all-string."""
    path = scratch_path(spark, "raw-csv")
    write_csv(raw_source(spark, sf_dir), path)
    return read_raw_csv(spark, path, fixed.RAW_COLUMNS)


def q_type_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.type_catalogue(staged_raw_catalogue(spark, sf_dir))


def q_rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_report(jobs.type_catalogue(staged_raw_catalogue(spark, sf_dir)), catalogue_rules())


def q_clean_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 itself: runs the whole cleaning (exact median included) every call."""
    return jobs.clean_catalogue(staged_raw_catalogue(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table as later steps read it (staged once per session)."""
    return staged_cleaned_catalogue(spark, sf_dir)


def q_outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.outlier_report(_cleaned(spark, sf_dir), fixed.OUTLIER_COLUMNS, relative_error=0.0)


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicate_keys(_cleaned(spark, sf_dir), "App Id")


def q_duplicate_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicate_key_count(_cleaned(spark, sf_dir), "App Id")


def q_stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stage_report(
        {"raw": staged_raw_catalogue(spark, sf_dir), "cleaned": staged_cleaned_catalogue(spark, sf_dir)}
    )


def q_reduce_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.reduce_columns(_cleaned(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.catalogue_features(jobs.reduce_columns(_cleaned(spark, sf_dir)))


def q_catalogue_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute_median(_features(spark, sf_dir), fixed.ML_NUMERIC)


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(read_table(spark, sf_dir, "part"), 10, [F.col("p_partkey")])


def q_index_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed, _ = FE.index_categories(read_table(spark, sf_dir, "part"), "p_brand", "brand_index")
    return indexed.groupBy("p_brand", "brand_index").agg(F.count(F.lit(1)).alias("n"))


def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.feature import OneHotEncoder

    indexed, _ = FE.index_categories(read_table(spark, sf_dir, "part"), "p_type", "type_index")
    enc = OneHotEncoder(inputCols=["type_index"], outputCols=["type_ohe"], handleInvalid="keep")
    out = FE.vectors_as_arrays(enc.fit(indexed).transform(indexed), ["type_ohe"])
    return out.groupBy("p_type", "type_ohe").agg(F.count(F.lit(1)).alias("n"))


def q_min_max_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return FE.min_max_columns(li, cols).select("l_orderkey", "l_linenumber", *[f"{c}_scaled" for c in cols])


def q_split_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return label_split(orders, "o_orderkey")


def q_split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = split_random(orders)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    return li.select(
        "l_orderkey",
        F.col("l_extendedprice").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"),
    )


def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.regression_metrics(_scored_lineitem(spark, sf_dir), digits=6)


def q_mean_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_by_key(_scored_lineitem(spark, sf_dir), "l_orderkey")
    return M.mean_baseline(train, test, digits=6)


def q_compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_by_key(_scored_lineitem(spark, sf_dir), "l_orderkey")
    return M.compare_models(
        M.regression_metrics(test, digits=6), M.mean_baseline(train, test, digits=6)
    )


def q_build_features(spark: SparkSession, sf_dir: str, **form) -> DataFrame:
    """Features + encoders fitted on the whole cleaned table; vectors as arrays."""
    transformed, _ = jobs.build_features(jobs.reduce_columns(_cleaned(spark, sf_dir)), **form)
    return FE.vectors_as_arrays(
        transformed,
        ["category_ohe", "content_rating_ohe", "numeric_features", "numeric_features_scaled", "features"],
    )


def q_build_features_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 in its older form: nine inputs, the label among them (reference day fixed)."""
    return q_build_features(spark, sf_dir, numeric=fixed.EARLY_NUMERIC, weekend_null_as=None)


def q_prepare_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base -> 70/30 split -> pipeline fitted on train only -> two Parquet
    tables (read back, both sides labelled).  Later steps of the session read
    these tables."""
    train, test = staged_ml_sets(spark, sf_dir, refresh=True)
    vecs = ["category_ohe", "content_rating_ohe", "numeric_features", "numeric_features_scaled", "features"]
    return FE.vectors_as_arrays(
        train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))), vecs
    )


def q_ml_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5's baseline: the mean label of the staged train rows scored on the test rows."""
    train, test = staged_ml_sets(spark, sf_dir)
    return M.mean_baseline(train, test, digits=3)


def q_forest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: train the forest on the staged E4 output, save it, score train, test
    and the mean baseline."""
    train, test = staged_ml_sets(spark, sf_dir)
    ev = jobs.train_and_evaluate(train, test, model_dir=scratch_path(spark, "forest"))
    return (
        ev.train_metrics.select(F.lit("train").alias("set"), "n", "rmse", "mae", "r2")
        .unionByName(ev.test_metrics.select(F.lit("test").alias("set"), "n", "rmse", "mae", "r2"))
        .unionByName(ev.baseline.select(F.lit("baseline").alias("set"), "n", "rmse", "mae", "r2"))
    )


def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the staged train rows, save, load, and read the importances."""
    train, _ = staged_ml_sets(spark, sf_dir)
    model_dir = scratch_path(spark, "forest")
    save_model(M.train_forest(train), model_dir)
    return M.feature_importance(load_model(model_dir), train, numeric_names=fixed.ML_NUMERIC)


# The source's questions are SQL text over a named view; the same text
# runs here with the frame bound by name instead of a global temp view.
SQL_HAVING_TEXT = """
    SELECT p_brand, COUNT(*) AS app_count, ROUND(AVG(p_size / CAST(10 AS DOUBLE)), 2) AS avg_rating
    FROM {t}
    WHERE p_size IS NOT NULL
    GROUP BY p_brand
    HAVING COUNT(*) >= 75
    ORDER BY avg_rating DESC NULLS LAST, app_count DESC NULLS LAST, p_brand ASC NULLS LAST
    LIMIT 10
"""


def q_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_query(spark, SQL_HAVING_TEXT, t=read_table(spark, sf_dir, "part"))


QUERIES.update(
    {
        "csv_scan": q_csv_scan,
        "type_catalogue": q_type_catalogue,
        "rule_report": q_rule_report,
        "clean_catalogue": q_clean_catalogue,
        "outlier_report": q_outlier_report,
        "duplicate_keys": q_duplicate_keys,
        "duplicate_key_count": q_duplicate_key_count,
        "stage_report": q_stage_report,
        "reduce_columns": q_reduce_columns,
        "catalogue_features": q_catalogue_features,
        "impute_median": q_impute_median,
        "preview": q_preview,
        "index_categories": q_index_categories,
        "one_hot": q_one_hot,
        "min_max_columns": q_min_max_columns,
        "split_by_key": q_split_by_key,
        "split_random": q_split_random,
        "regression_metrics": q_regression_metrics,
        "mean_baseline": q_mean_baseline,
        "compare_models": q_compare_models,
        "build_features": q_build_features,
        "build_features_early": q_build_features_early,
        "prepare_ml": q_prepare_ml,
        "ml_baseline": q_ml_baseline,
        "forest_metrics": q_forest_metrics,
        "feature_importance": q_feature_importance,
        "sql_query": q_sql_query,
    }
)


# ------------------------------------------------- one query per operator family

_ID = ["App Name", "App Id"]


def _raw_cols(spark: SparkSession, sf_dir: str, cols) -> DataFrame:
    return staged_raw_catalogue(spark, sf_dir).select(*[F.col(f"`{c}`") for c in _ID + list(cols)])


def q_parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with '+' and commas, '$' prices, plain numbers."""
    raw = _raw_cols(spark, sf_dir, ["Installs", "Minimum Installs", "Maximum Installs", "Price", "Rating", "Rating Count"])
    return raw.select(
        *_ID,
        P.parse_count("Installs").alias("installs"),
        P.parse_count("Minimum Installs", fixed.COMMA_STRIP_CHARS).alias("min_installs"),
        P.parse_count("Maximum Installs", fixed.COMMA_STRIP_CHARS).alias("max_installs"),
        P.parse_price("Price").alias("price"),
        P.parse_double("Rating").alias("rating"),
        P.parse_count("Rating Count", None).alias("rating_count"),
    )


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5: 'MMM d, yyyy' dates and 'yyyy-MM-dd HH:mm:ss' timestamps."""
    raw = _raw_cols(spark, sf_dir, ["Released", "Last Updated", "Scraped Time"])
    return raw.select(
        *_ID,
        P.parse_date("Released").alias("released"),
        P.parse_date("Last Updated").alias("updated"),
        P.parse_timestamp("Scraped Time").alias("scraped"),
    )


def q_parse_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size text -> kilobytes (M x1024, k x1, anything else null)."""
    raw = _raw_cols(spark, sf_dir, ["Size"])
    return raw.select(*_ID, "Size", P.parse_size_kb("Size").alias("size_kb"))


def q_parse_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose true/false text -> boolean -> 1.0/0.0; free flag from price."""
    raw = _raw_cols(spark, sf_dir, ["Ad Supported", "Editors Choice", "Price"])
    ad = P.parse_flag("Ad Supported")
    return raw.select(
        *_ID,
        ad.alias("ad_supported"),
        P.flag_to_number(ad).alias("ad_supported_num"),
        P.parse_flag("Editors Choice").alias("editors_choice"),
        P.free_flag(P.parse_price("Price")).alias("free"),
    )


def q_parse_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First version number in text."""
    raw = _raw_cols(spark, sf_dir, ["Minimum Android"])
    return raw.select(*_ID, "Minimum Android", P.parse_version("Minimum Android").alias("version"))


def q_enforce_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F4 on the typed catalogue: the rows that pass every rule."""
    return enforce_rules(jobs.type_catalogue(staged_raw_catalogue(spark, sf_dir)), catalogue_rules())


def q_fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median of Size_KB over the rule-passing rows fills its nulls."""
    valid = jobs.validated_catalogue(staged_raw_catalogue(spark, sf_dir))
    return fill_median(valid, ["Size_KB"]).select(*_ID, "Size", "Size_KB")


def q_fill_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 (+ the type guard): per-column constants for missing text."""
    raw = _raw_cols(spark, sf_dir, list(fixed.TEXT_FILLS))
    return fill_constants(raw, fixed.TEXT_FILLS)


def q_replace_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null or 'XXX' currency -> 'USD'."""
    return replace_sentinel(_raw_cols(spark, sf_dir, ["Currency"]), "Currency")


def q_date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6-D8 on orders: days from the order date to a reference day, weekend flag."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return orders.select(
        "o_orderkey",
        days_since("d", ORDERS_AS_OF).alias("days_since"),
        weekend_flag("d").alias("is_weekend"),
    )


QUERIES.update(
    {
        "parse_numbers": q_parse_numbers,
        "parse_dates": q_parse_dates,
        "parse_sizes": q_parse_sizes,
        "parse_flags": q_parse_flags,
        "parse_versions": q_parse_versions,
        "enforce_rules": q_enforce_rules,
        "fill_median": q_fill_median,
        "fill_constants": q_fill_constants,
        "replace_sentinel": q_replace_sentinel,
        "date_features": q_date_features,
    }
)


# -------------------------------------- the nine questions on the pipeline's own output

_LABEL = "Maximum Installs"


def q_catalogue_top_by_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, with a group of missing categories."""
    return G.top_groups_by_mean(_features(spark, sf_dir), "Category", _LABEL)


def q_catalogue_mean_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2; missing ratings go."""
    return G.mean_by_rounded_level(_features(spark, sf_dir), "Rating", _LABEL)


def q_catalogue_top_min_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 at its own threshold; sizes have groups on both sides of it at every scale."""
    return G.top_groups_min_size(_features(spark, sf_dir), "Size_KB", "Rating")


def q_catalogue_mean_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4; a missing price is not free."""
    return G.mean_by_flag(_features(spark, sf_dir), "Price", _LABEL)


def q_catalogue_mean_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5."""
    return G.mean_by_band(_features(spark, sf_dir), "app_age_days", _LABEL)


def q_catalogue_best_subgroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6."""
    return G.best_subgroup_per_group(_features(spark, sf_dir), "Category", "Content Rating", _LABEL)


def q_catalogue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7; rows without a price go, missing categories are not counted."""
    return G.numeric_summary(_features(spark, sf_dir), "Category", "Price", "Rating Count")


def q_catalogue_top_by_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 over the rows with a category, a rating and a count."""
    return G.top_groups_by_total(_features(spark, sf_dir), "Category", _LABEL, rating="Rating")


def q_catalogue_rating_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2."""
    return G.rating_bucket_stats(_features(spark, sf_dir), "Category", "Rating", _LABEL, digits=2)


QUERIES.update(
    {
        "catalogue_top_by_mean": q_catalogue_top_by_mean,
        "catalogue_mean_by_level": q_catalogue_mean_by_level,
        "catalogue_top_min_size": q_catalogue_top_min_size,
        "catalogue_mean_by_flag": q_catalogue_mean_by_flag,
        "catalogue_mean_by_band": q_catalogue_mean_by_band,
        "catalogue_best_subgroup": q_catalogue_best_subgroup,
        "catalogue_summary": q_catalogue_summary,
        "catalogue_top_by_total": q_catalogue_top_by_total,
        "catalogue_rating_buckets": q_catalogue_rating_buckets,
    }
)


# ---------------------------------------------------------------- approximate forms


def q_approx_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 with its error bound: whether each sketch's quartiles keep to it."""
    df = _cleaned(spark, sf_dir)
    asked = [0.25, 0.75]
    got = quantile_values(df, fixed.OUTLIER_COLUMNS, asked, fixed.OUTLIER_QUANTILE_ERROR)
    values = [(c, p, v) for c in fixed.OUTLIER_COLUMNS for p, v in zip(asked, got[c], strict=True) if v is not None]
    return rank_check(df, values, fixed.OUTLIER_QUANTILE_ERROR)


def q_approx_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 as the approximate summary has it: whether its percentiles keep to 1 / accuracy."""
    accuracy = 10_000
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_tax", "l_extendedprice")
    row = G.numeric_summary(li, "l_returnflag", "l_tax", "l_extendedprice", exact=False, accuracy=accuracy).first()
    values = [("l_tax", 0.5, row["median_price"])]
    values += [("l_extendedprice", p, row[n]) for p, n in ((0.25, "installs_p25"), (0.5, "median_installs"), (0.75, "installs_p75"))]
    return rank_check(li, values, 1 / accuracy)


QUERIES.update({"approx_quantiles": q_approx_quantiles, "approx_summary": q_approx_summary})


# ------------------------------------------------ a forest whose answer is determined


def q_forest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M8, M9: one tree of depth 1 over all rows on a feature with fewer values than
    bins, so the split point and both leaf means can be computed elsewhere."""
    from pyspark.ml.feature import VectorAssembler

    li = read_table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_quantity").cast("double").alias("label"))
    rows = VectorAssembler(inputCols=["l_linenumber"], outputCol="features").transform(li)
    stump = M.train_forest(rows, num_trees=1, maxDepth=1, bootstrap=False)
    scored = M.predict(stump, rows).select("l_linenumber", F.round("prediction", 6).alias("prediction"))
    return scored.groupBy("l_linenumber", "prediction").agg(F.count(F.lit(1)).alias("n"))


QUERIES["forest_stump"] = q_forest_stump
