"""Queries on what outlives a job: saved models, sketches, partitions, quarantined records,
stage logs and splits by row locators.  Same contract as ``bindings``."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.functions.dates import days_since
from catalytics.operators import features as FE
from catalytics.operators import forest_tables as FT
from catalytics.operators import groupstats as G
from catalytics.operators import model as M
from catalytics.operators import sketches as SK
from catalytics.operators.quantiles import rank_check
from catalytics.operators.reports import StageLog
from catalytics.operators.split import split_by_locator, split_sizes
from catalytics.plans import jobs
from catalytics.plans.bindings import ORDERS_AS_OF
from catalytics.plans.stages import raw_source, staged_cleaned_catalogue, staged_ml_sets
from catalytics.sources.checked import account, read_checked_csv
from catalytics.sources.inference import infer_types, read_typed_csv
from catalytics.sources.io import (
    FILE_ROWS,
    cut_lineage,
    load_model,
    read_raw_csv,
    read_stage,
    read_table,
    replace_partitions,
    save_model,
    scratch_path,
    write_csv,
    write_stage,
)

# ------------------------------------------------------------------ saved forests


def _saved_forest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    train, test = staged_ml_sets(spark, sf_dir)
    return train, test, save_model(M.train_forest(train), scratch_path(spark, "forest"))


def q_forest_by_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, M9, E5: the saved 20-tree forest scored by joins with its node table, compared
    with the loaded model on every row of both sets."""
    train, test, path = _saved_forest(spark, sf_dir)
    both = train.withColumn("set", F.lit("train")).unionByName(test.withColumn("set", F.lit("test")))
    scored = M.predict(load_model(path), both).select("set", "features", "prediction")
    scored = cut_lineage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    nodes = FT.node_table(spark, path)
    tabled = scored.drop("features").join(FT.score_by_table(scored, nodes, "row"), "row", "left")
    apart = F.coalesce(F.abs(F.col("prediction") - F.col("table_prediction")), F.lit(float("inf")))
    trees = nodes.agg(F.countDistinct("tree")).first()[0]
    return tabled.groupBy("set").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(trees).alias("trees"),
        F.count_if(apart > 0).alias("n_differing"),
        F.max(apart).alias("max_difference"),
    )


def q_importances_by_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances summed over the node table, compared with the model's, per slot."""
    train, _, path = _saved_forest(spark, sf_dir)
    model = FT.importances_by_table(FT.node_table(spark, path))
    wanted = M.feature_importance(load_model(path), train, numeric_names=fixed.ML_NUMERIC)
    both = wanted.join(model, F.col("slot") == F.col("feature"), "left")
    near = F.abs(wanted["importance"] - F.coalesce(model["importance"], F.lit(0.0))) <= 1e-9
    return both.select("slot", near.alias("agrees"))


_TREE_INPUTS = ["l_linenumber", "l_discount", "l_tax"]


def _grown_tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, node table) of one tree of depth 2 on inputs with fewer values than bins."""
    from pyspark.ml.feature import VectorAssembler

    li = read_table(spark, sf_dir, "lineitem").select(*_TREE_INPUTS, F.col("l_quantity").cast("double").alias("label"))
    rows = VectorAssembler(inputCols=_TREE_INPUTS, outputCol="features").transform(li)
    tree = M.train_forest(rows, num_trees=1, maxDepth=2, bootstrap=False)
    return rows, FT.node_table(spark, save_model(tree, scratch_path(spark, "tree")))


def q_tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 where the tree can be grown elsewhere: importances of two levels of best splits."""
    _, nodes = _grown_tree(spark, sf_dir)
    names = F.array(*map(F.lit, _TREE_INPUTS))
    return FT.importances_by_table(nodes).select(F.get(names, F.col("feature")).alias("input"), F.round("importance", 6).alias("importance"))


def q_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 by joins, where the tree can be grown elsewhere: every kind of row and its prediction."""
    rows, nodes = _grown_tree(spark, sf_dir)
    kinds = rows.groupBy(*_TREE_INPUTS).agg(F.count(F.lit(1)).alias("n"), F.first("features").alias("features"))
    kinds = cut_lineage(kinds.withColumn("kind", F.monotonically_increasing_id()), "kinds")
    scored = kinds.drop("features").join(FT.score_by_table(kinds, nodes, "kind"), "kind")
    return scored.select(*_TREE_INPUTS, "n", F.round("table_prediction", 6).alias("prediction"))


def q_tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 as rules: every leaf with its prediction and how many conditions lead to it."""
    _, nodes = _grown_tree(spark, sf_dir)
    conditions = F.size(F.split("rule", " and "))
    return FT.tree_rules(nodes).select(F.round("prediction", 6).alias("prediction"), conditions.alias("conditions"))


#: Rows updated from this day on came after the model was saved.
_SAVED_ON = "1997-01-01"


def q_model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fitted pipeline (imputer to forest) saved, loaded, and scored on rows
    that came later, next to the model that was never saved."""
    featured = FE.catalogue_features(jobs.reduce_columns(staged_cleaned_catalogue(spark, sf_dir)))
    rows = cut_lineage(featured.select("*", F.col("Maximum Installs").cast("double").alias("label"), *[F.col(f"`{c}`").cast("double").alias(f"{c}#") for c in fixed.ML_NUMERIC]), "round-trip")
    rows = rows.drop(*fixed.ML_NUMERIC).withColumnsRenamed({f"{c}#": c for c in fixed.ML_NUMERIC})
    steps = FE.feature_pipeline(fixed.ML_NUMERIC, FE.CATALOGUE_CATEGORICAL, impute=True).getStages()
    forest = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=fixed.FOREST_TREES, seed=fixed.FOREST_SEED)
    known = rows.filter((F.col("Last Updated") < _SAVED_ON) & F.col("label").isNotNull())
    fitted = Pipeline(stages=[*steps, forest]).fit(known)
    loaded = load_model(save_model(fitted, scratch_path(spark, "whole-pipeline")), "pipeline")
    later = rows.filter(F.col("Last Updated") >= _SAVED_ON)
    before = fitted.transform(later).withColumnsRenamed({"prediction": "before", "features": "features_before"})
    drop = [c for c in before.columns if c not in {*rows.columns, "before", "features_before"}]
    both = loaded.transform(before.drop(*drop))
    same = F.col("before").eqNullSafe(F.col("prediction")) & (vector_to_array("features_before") == vector_to_array("features"))
    return both.groupBy(F.year("Last Updated").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_differing"))


def q_vector_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: the width by the column's metadata, next to the vectors' own sizes."""
    train, _ = staged_ml_sets(spark, sf_dir)
    size = F.size(vector_to_array("features"))
    widths = train.agg(F.min(size).alias("least"), F.max(size).alias("most"))
    return widths.select(F.lit(FE.vector_width(train, "features")).alias("width"), "least", "most")


# ---------------------------------------------------------------- splits of rows


def q_split_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/30 by a seeded hash of each row's locator, every row with its part."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return split_by_locator(li, ["l_orderkey", "l_linenumber"])


def q_split_stable_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 in three parts under few and many partitions: the same sizes, within the binomial bound."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    weights, out = (0.6, 0.3, 0.1), None
    for n in (4, 64):
        parts = split_by_locator(li.repartition(n), ["l_orderkey", "l_linenumber"], weights, seed=7)
        sizes = split_sizes(parts, weights).select(F.lit(n).alias("partitions"), "part", "n", "within")
        out = sizes if out is None else out.unionByName(sizes)
    return out


# ------------------------------------------------------------------ text of unknown form


def q_infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's text read back without knowing any type."""
    path = scratch_path(spark, "untyped-csv")
    write_csv(raw_source(spark, sf_dir), path)
    return infer_types(read_raw_csv(spark, path, fixed.RAW_COLUMNS))


_TYPED = ["App Id", "Rating", "Rating Count", "Maximum Installs", "Free", "In App Purchases", "Scraped Time", "Size"]


def q_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of unknown types read as the types that were found."""
    path = scratch_path(spark, "untyped-csv")
    write_csv(raw_source(spark, sf_dir), path)
    typed, _ = read_typed_csv(spark, path)
    return typed.select("App Name", *[f"`{c}`" for c in _TYPED])


def q_checked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's text with records that lack a field, have one too many, or hold
    quotes, commas and line ends; each outcome with its number of records and a sum (characters
    of the names read, fields of the records refused)."""
    raw = raw_source(spark, sf_dir)
    kind = F.col("App Id").cast("long") % 10
    name = F.when(kind == 3, F.concat("App Name", F.lit('\n"a", b'))).otherwise(F.col("App Name"))
    quoted = {c: F.concat(F.lit('"'), F.replace(F.coalesce(name if c == "App Name" else F.col(f"`{c}`"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in fixed.RAW_COLUMNS}
    whole = F.concat_ws(",", *quoted.values())
    line = F.when(kind == 1, F.concat_ws(",", *list(quoted.values())[:-1])).when(kind == 2, F.concat_ws(",", whole, F.lit("more"))).otherwise(whole)
    path = scratch_path(spark, "damaged-text")
    raw.select(line.alias("value")).write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=FILE_ROWS).text(path)
    rows, refused = read_checked_csv(spark, path, fixed.RAW_COLUMNS, header=False)
    sums = rows.agg(F.sum(F.length("App Name")).alias("total")).select(F.lit("read").alias("outcome"), "total")
    sums = sums.unionByName(refused.groupBy(F.col("reason").alias("outcome")).agg(F.sum("n_fields").alias("total")))
    return account(rows, refused).join(sums, "outcome")


# ------------------------------------------------------------ counts, sketches, sinks


def _logged(spark: SparkSession, sf_dir: str) -> StageLog:
    log = StageLog(spark)
    raw = log.write("raw", raw_source(spark, sf_dir))
    log.write("cleaned", jobs.clean_catalogue(raw))
    return log


def q_observed_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 from the jobs that write the stages."""
    return _logged(spark, sf_dir).report()


def q_observed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: missing values per column, counted by the same jobs."""
    return _logged(spark, sf_dir).missing()


def q_merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 batches sketched and stored in two runs, merged without their rows;
    whether each quantile's counted rank keeps to the bound."""
    columns, path = ["l_extendedprice", "l_quantity", "l_discount"], scratch_path(spark, "sketches")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", *columns).withColumn("batch", F.col("l_orderkey") % 100)
    for half in (F.col("batch") < 50, F.col("batch") >= 50):
        SK.store_sketches(SK.sketch_batches(li.filter(half), "batch", columns), path)
    got = SK.merged_quantiles(read_stage(spark, path), [0.01, 0.25, 0.5, 0.75, 0.99])
    values = [(r["column"], r["p"], r["value"]) for r in got.collect()]  # a row per column and p
    return rank_check(li, values, SK.rank_bound())


def q_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: one partition of a stored table replaced, the others as they were."""
    path = scratch_path(spark, "partitioned")
    df = staged_cleaned_catalogue(spark, sf_dir).select("App Name", "Rating Count", "Content Rating")
    write_stage(df, path, partition_by=["Content Rating"])
    newer = df.filter(F.col("Content Rating") == "P").withColumn("Rating Count", F.col("Rating Count") + 1000)
    replace_partitions(newer, path, ["Content Rating"])
    return read_stage(spark, path).groupBy("Content Rating").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Rating Count").alias("total"), F.countDistinct("App Name").alias("names")
    )


def q_hashed_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M2 for a column of any number of categories: each row has one slot, each category
    one, all categories are accounted for by slots."""
    df = staged_cleaned_catalogue(spark, sf_dir).select("App Id")
    slot = vector_to_array("`App Id_hashed`")
    hashed = FE.hashed_categories(df, ["App Id"]).select("App Id", F.array_position(slot, F.lit(1.0)).alias("slot"), F.aggregate(slot, F.lit(0.0), lambda s, x: s + x).alias("set"))
    kinds = hashed.groupBy("App Id").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.max("set").alias("set"))
    found = kinds.agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.sum("n").alias("n"),
        F.count_if((F.col("low") != F.col("high")) | (F.col("set") != 1) | (F.col("high") > FE.HASHED_WIDTH)).alias("n_wrong"),
        F.countDistinct("low").alias("slots"),
    )
    asked = FE.hash_collisions(df, ["App Id"]).select("column", F.col("n_categories").alias("counted"), "n_slots")
    both = found.join(asked, (F.col("counted") == F.col("n_categories")) & (F.col("n_slots") == F.col("slots")))
    return both.select("column", "n_categories", "n", "n_wrong", (F.col("n_slots") <= FE.HASHED_WIDTH).alias("fits"))


def q_pipeline_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 with a column of too many categories for an indexer: per content rating the width of
    the features and how many slots are set by the hashed part."""
    df = staged_cleaned_catalogue(spark, sf_dir).select("Category", "Content Rating", "Developer Id", F.col("Rating Count").cast("double").alias("Rating Count"))
    pipe = FE.feature_pipeline(["Rating Count"], FE.CATALOGUE_CATEGORICAL, hashed=["Developer Id"], hashed_width=256)
    _, out = FE.fit_transform(pipe, df, df)
    values = vector_to_array("features")
    in_hash = F.aggregate(F.slice(values, F.size(values) - 255, 256), F.lit(0.0), lambda s, x: s + x)
    return out.groupBy("Content Rating").agg(F.count(F.lit(1)).alias("n"), F.max(F.size(values)).alias("width"), F.sum(in_hash).cast("bigint").alias("n_hashed"))


# --------------------------------------------------------------------- other days


def q_date_features_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from the order date to the day of the run."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return orders.select("o_orderkey", days_since("d", "today").alias("days_since"))


def q_catalogue_mean_by_band_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 on the catalogue as of a day on which it has apps of every age."""
    featured = FE.catalogue_features(jobs.reduce_columns(staged_cleaned_catalogue(spark, sf_dir)), as_of=ORDERS_AS_OF)
    return G.mean_by_band(featured, "app_age_days", "Maximum Installs")


QUERIES = {
    "forest_by_tables": q_forest_by_tables,
    "importances_by_tables": q_importances_by_tables,
    "tree_importance": q_tree_importance,
    "tree_scores": q_tree_scores,
    "tree_leaves": q_tree_leaves,
    "model_round_trip": q_model_round_trip,
    "vector_width": q_vector_width,
    "split_stable": q_split_stable,
    "split_stable_sizes": q_split_stable_sizes,
    "infer_types": q_infer_types,
    "typed_csv": q_typed_csv,
    "checked_csv": q_checked_csv,
    "observed_stages": q_observed_stages,
    "observed_missing": q_observed_missing,
    "merged_sketches": q_merged_sketches,
    "replace_partition": q_replace_partition,
    "hashed_categories": q_hashed_categories,
    "pipeline_hashed": q_pipeline_hashed,
    "date_features_today": q_date_features_today,
    "catalogue_mean_by_band_then": q_catalogue_mean_by_band_then,
}
