"""Behaviour at the edges the survey lists as traps."""

from pyspark.sql import functions as F

from catalytics.operators import groupstats as G
from catalytics.operators.missing import fill_constants, fill_median


def test_text_fill_skips_numeric_columns(spark, ansi):  # T4
    df = spark.createDataFrame([(None, None)], "n double, s string")
    row = fill_constants(df, {"n": "Unknown", "s": "Unknown"}).first()
    assert row["n"] is None and row["s"] == "Unknown"


def test_median_of_all_null_column_leaves_nulls(spark):  # T8
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (None, None)], "a double, b double")
    rows = fill_median(df, ["a", "b"]).collect()
    assert [r["a"] for r in rows] == [None, None, None]
    assert sorted(r["b"] for r in rows) == [1.0, 1.0, 3.0]


def test_null_price_is_paid(spark):  # T9
    df = spark.createDataFrame([(0.0, 10.0), (None, 20.0), (1.0, 30.0)], "price double, v double")
    got = {r["app_type"]: r["total_apps"] for r in G.mean_by_flag(df, "price", "v").collect()}
    assert got == {"Free": 1, "Paid": 2}


def test_negative_age_is_less_than_a_year(spark):  # T12
    df = spark.createDataFrame([(-5, 1.0), (None, 2.0), (400, 3.0)], "age int, v double")
    got = {r["app_age_group"]: r["total_apps"] for r in G.mean_by_band(df, "age", "v").collect()}
    assert got == {"Less than 1 year": 1, "1 to 3 years": 1}


def test_nan_rating_is_dropped_before_buckets(spark):  # T22
    df = spark.createDataFrame(
        [("a", float("nan"), 5), ("a", 5.0, 7), ("a", 5.5, 9), ("a", -0.1, 1), ("a", 0.0, 3)],
        "c string, r double, v long",
    )
    got = [tuple(x) for x in G.rating_bucket_stats(df, "c", "r", "v").collect()]
    assert got == [("0-1", 1, 3.0), ("4-5", 1, 7.0)]


def test_ratings_round_half_up(spark):  # T11 (rounded levels)
    df = spark.createDataFrame([(0.5, 1.0), (1.5, 1.0), (2.5, 1.0), (4.4, 1.0)], "r double, v double")
    got = sorted(r["rating_level"] for r in G.mean_by_rounded_level(df, "r", "v").collect())
    assert got == [1.0, 2.0, 3.0, 4.0]


def test_long_counts_keep_every_digit(spark, ansi):
    from catalytics.functions.parse import parse_count

    texts = ["9007199254740993", "9,223,372,036,854,775,000+", "64.0", "junk", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in rows.select("i", parse_count("t").alias("n")).orderBy("i").collect()]
    assert got == [9007199254740993, 9223372036854775000, 64, None, None]


def test_a_replaced_source_table_is_read_again(spark, tmp_path):
    from catalytics.plans.stages import staged_raw_catalogue

    folder, source = str(tmp_path), "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/orders.parquet").write.parquet(f"{folder}/orders.parquet")
    items = spark.read.parquet(f"{source}/lineitem.parquet")
    items.write.parquet(f"{folder}/lineitem.parquet")
    before = staged_raw_catalogue(spark, folder).count()
    items.where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    after = staged_raw_catalogue(spark, folder).count()
    assert before == items.count() and after == items.where("l_orderkey % 2 = 0").count()


def test_prepared_sides_do_not_depend_on_the_layout(spark):
    from catalytics.operators.features import catalogue_features
    from catalytics.plans import jobs
    from catalytics.plans.stages import staged_cleaned_catalogue

    featured = catalogue_features(jobs.reduce_columns(staged_cleaned_catalogue(spark, "/root/testdata/sf0.001")))
    sizes = []
    for n in (2, 5):
        train, test, _ = jobs.prepare_ml(featured.repartition(n))
        sizes.append((train.count(), test.count(), train.agg({"label": "sum"}).first()[0]))
    assert sizes[0] == sizes[1]


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    from catalytics.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
