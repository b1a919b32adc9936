"""Stages of the raw catalogue whose partitions, files and plans keep their size as the input grows."""

import pytest
from pyspark.sql import functions as F

from catalytics.functions.parse import parse_count
from catalytics.operators import quantiles
from catalytics.plans import catalogue, jobs, stages, stored
from catalytics.plans.bindings import q_csv_scan
from catalytics.sources import io
from catalytics.sources.checked import read_checked_csv
from catalytics.sources.inference import BLOCK, BOOLEAN, infer_types, value_class


@pytest.fixture
def tables(spark, tmp_path):
    """40 line items of 10 orders, and one without an order."""
    one = F.lit(1.0)
    ids = spark.range(41).withColumn("l_orderkey", F.col("id") % 11)
    li = ids.select(
        "l_orderkey",
        F.col("id").alias("l_partkey"),
        F.col("id").alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") + one).alias("l_quantity"),
        (F.col("id") * 100 + one).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"),
        F.lit(0.02).alias("l_tax"),
        F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.lit("1996-03-13").cast("timestamp").alias("l_shipdate"),
    )
    orders = spark.range(10).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") * 1000.0).alias("o_totalprice"),
        F.lit("1996-01-02").cast("timestamp").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
        F.lit("O").alias("o_orderstatus"),
    )
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_join_partitions_grow_in_number(spark, tables, monkeypatch):
    whole = sorted(map(tuple, catalogue.raw_catalogue(spark, tables).collect()), key=str)
    monkeypatch.setattr(catalogue, "JOIN_ROWS", 6)
    dealt = catalogue.raw_catalogue(spark, tables)
    assert dealt.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, dealt.collect()), key=str) == whole and len(whole) == 38


def test_csv_is_compressed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "FILE_ROWS", 10)
    df = spark.range(0, 25, 1, 1).select(F.col("id").cast("string").alias("a"), F.lit(' x, "y" ').alias("b"))
    path = io.write_csv(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*.csv.gz"))) == 3
    assert sorted(map(tuple, io.read_raw_csv(spark, path, ["a", "b"]).collect())) == sorted(map(tuple, df.collect()))


def test_text_is_written_without_a_raw_stage(spark, tables):
    key = stages._key(spark, tables, "raw")
    assert q_csv_scan(spark, tables).count() == 38 and stored.q_infer_types(spark, tables).count() == 24
    assert key not in stages._STAGED
    stages.staged_raw_catalogue(spark, tables)
    assert stages.raw_source(spark, tables).inputFiles() == stages.staged_raw_catalogue(spark, tables).inputFiles()


def test_checked_records_are_not_sorted_into_folders(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n1\n3,4\n")
    rows, refused = read_checked_csv(spark, str(tmp_path / "t.csv"), ["a", "b"])
    assert not any("refused=" in f for f in rows.inputFiles())
    assert (rows.count(), refused.count()) == (2, 1)


def test_one_class_expression_for_a_block_of_columns(spark):
    names = [f"c{i}" for i in range(2 * BLOCK + 1)]
    df = spark.createDataFrame([tuple("true" if i % 2 else "1.5" for i in range(len(names)))] * 3 + [(None,) * len(names)], [f"{n}" for n in names])
    report = infer_types(df)
    assert report._jdf.queryExecution().optimizedPlan().toString().count(BOOLEAN) <= 3
    got = {r["position"]: (r["column"], r["type"], r["n_missing"], r["n_boolean"], r["n_double"]) for r in report.collect()}
    assert got == {i: (n, "boolean" if i % 2 else "double", 1, 3 * (i % 2), 3 - 3 * (i % 2)) for i, n in enumerate(names)}


def test_classes_of_odd_values(spark, ansi):
    want = {
        "TRUE": "boolean", "true\n": "boolean", "tru": "text", "+7": "long", "-": "text", ".5": "double", "1.": "double",
        "2024-02-29": "date", "2024-02-29\n": "date", "2024-02-30": "text", "2024-02-29T10:00:00.5": "timestamp", "é": "text", " ": None, "\t1": "text",
        "1234567890123456789": "double", "٣": "text",
    }
    df = spark.createDataFrame([(v,) for v in want], "v string")
    assert {r.v: r.k for r in df.select("v", value_class(F.col("v")).alias("k")).collect()} == want


def test_text_with_a_dot_is_not_tried_as_a_whole_number(spark, ansi):
    want = {"64.0": 64, "-1.9": -1, "9007199254740993": 9007199254740993, " 8 ": 8, "1E3": 1000, ".": None, "x": None}
    df = spark.createDataFrame([(v,) for v in want], "v string").select("v", parse_count("v", None).alias("n"))
    assert {r.v: r.n for r in df.collect()} == want
    assert "contains(" in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_cleaned_rows_are_written_once_without_a_raw_stage(spark, tables):
    cleaned = stages.staged_cleaned_catalogue(spark, tables)
    assert stages._key(spark, tables, "raw") not in stages._STAGED
    folders = {f.split("/catalytics-")[1].split("-")[0] for f in cleaned.inputFiles()}
    assert folders == {"validated"}
    assert stages.staged_cleaned_catalogue(spark, tables).inputFiles() == cleaned.inputFiles()
    again = jobs.clean_catalogue(stages.staged_raw_catalogue(spark, tables))
    assert sorted(map(str, cleaned.collect())) == sorted(map(str, again.collect())) and cleaned.count() > 0


def test_rules_compare_text_made_below_the_join(spark, tables):
    plan = jobs.validated_catalogue(catalogue.raw_catalogue(spark, tables))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "gettimestamp" in join and "format_number" not in join and "date_format" not in join


def test_wide_projections_run_in_methods_the_jvm_compiles(spark, raw, monkeypatch):
    limits, write = [], jobs.cut_lineage
    monkeypatch.setattr(jobs, "cut_lineage", lambda df, name: limits.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) or write(df, name))
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    jobs.clean_catalogue(raw)
    assert limits == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_medians_of_few_values_are_counted_without_sketches(spark, monkeypatch):
    rows = [(float(i % 5), float(i), None) for i in range(100)] + [(float("nan"), None, None), (-1.0, 2.5, None)]
    df = spark.createDataFrame(rows, "few double, many double, none double")
    wanted, asked, exact = {"few": [-1.0, 2.0], "many": [0.0, 49.0], "none": [None, None]}, [], quantiles._exact_quantiles
    monkeypatch.setattr(quantiles, "_exact_quantiles", lambda df, columns, probs: asked.append(columns) or exact(df, columns, probs))
    assert quantiles.quantile_values(df, list(wanted), [0.0, 0.5]) == wanted and asked == []
    monkeypatch.setattr(quantiles, "COUNTED_VALUES", 20)
    assert quantiles.quantile_values(df, list(wanted), [0.0, 0.5]) == wanted and asked == [["many"]]
