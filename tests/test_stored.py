"""Saved forests as tables, stable splits, inferred and checked text, logged stages, stored
sketches, replaced partitions and hashed categories."""

import os
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from catalytics.operators import features as FE
from catalytics.operators import forest_tables as FT
from catalytics.operators import sketches as SK
from catalytics.operators.reports import StageLog, stage_report
from catalytics.operators.split import split_by_locator, split_sizes, with_file_locator
from catalytics.sources.checked import account, field_count, read_checked_csv
from catalytics.sources.inference import as_inferred, infer_types, inferred_schema, read_typed_csv
from catalytics.sources.io import cut_lineage, read_stage, replace_partitions, save_model, write_stage


# ------------------------------------------------------------------ saved forests


@pytest.fixture(scope="module")
def forest(spark, tmp_path_factory):
    """A forest over two ordered inputs and a one-hot category."""
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.gauss(0, 1), "abcd"[rng.randrange(4)]) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string")
    df = df.withColumn("label", F.col("a") * 10 + F.when(F.col("c") == "b", 4).otherwise(0) + F.col("b"))
    out = FE.feature_pipeline(["a", "b"], [("c", "ci", "ch")]).fit(df).transform(df)
    model = RandomForestRegressor(numTrees=9, seed=3, maxDepth=6).fit(out)
    path = save_model(model, str(tmp_path_factory.mktemp("forest") / "model"))
    return out, model, FT.node_table(spark, path)


def test_table_scores_equal_the_model(forest):
    rows, model, nodes = forest
    scored = cut_lineage(model.transform(rows).select("id", "features", "prediction"), "scored")
    both = scored.join(FT.score_by_table(scored, nodes, "id"), "id", "left")
    assert both.count() == 1500 and both.filter(~F.col("prediction").eqNullSafe(F.col("table_prediction"))).count() == 0
    kinds = {(r.threshold is None, r.goes_left is None) for r in nodes.filter("left IS NOT NULL").collect()}
    assert kinds == {(False, True), (True, False)}  # ordered splits and splits on a category


def test_table_importances_equal_the_model(forest):
    _, model, nodes = forest
    got = {r.feature: r.importance for r in FT.importances_by_table(nodes).collect()}
    want = model.featureImportances.toArray()
    assert all(abs(got.get(i, 0.0) - x) < 1e-9 for i, x in enumerate(want)) and abs(sum(got.values()) - 1) < 1e-9


def test_every_leaf_has_its_rule(forest):
    _, model, nodes = forest
    assert FT.depth_of(nodes) == max(t.depth for t in model.trees)
    rules = FT.tree_rules(nodes)
    leaves = nodes.filter("left IS NULL")
    assert rules.count() == leaves.count() == rules.select("tree", "node").distinct().count()
    assert rules.filter(~F.col("rule").rlike("^(not )?x[0-9]+ (<=|in) ")).count() == 0


def test_forest_of_single_leaves(spark, tmp_path):
    rows = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(20).withColumn("label", F.lit(3.0)))
    nodes = FT.node_table(spark, save_model(RandomForestRegressor(numTrees=2, seed=1).fit(rows), str(tmp_path / "m")))
    assert {r.table_prediction for r in FT.score_by_table(rows, nodes, "id").collect()} == {3.0}
    assert FT.importances_by_table(nodes).count() == 0 and FT.tree_rules(nodes).count() == 2


# ------------------------------------------------------------------------- splits


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("k"))
    sides = [{(r.id, r.part) for r in split_by_locator(df.repartition(n), ["id", "k"], (5, 3, 2), seed=9).collect()} for n in (1, 64)]
    assert sides[0] == sides[1] and len(sides[0]) == 20_000
    other = {(r.id, r.part) for r in split_by_locator(df, ["id", "k"], (5, 3, 2), seed=10).collect()}
    assert 0.36 < len(other & sides[0]) / 20_000 < 0.40  # .25 + .09 + .04: parts agree by chance only
    sizes = split_sizes(split_by_locator(df, ["id", "k"], (5, 3, 2), seed=9), (5, 3, 2)).collect()
    assert len(sizes) == 3 and all(r.within for r in sizes)


def test_split_by_place_in_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30_000).select((F.col("id") % 3).alias("x")).repartition(3).write.parquet(path)
    counts = []
    for size in ("128m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = split_by_locator(with_file_locator(spark.read.parquet(path)), ["locator"])
        counts.append({(r.locator, r.part) for r in rows.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert counts[0] == counts[1] and len(counts[0]) == 30_000


def test_split_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, "")], "k int, t string")
    rows = split_by_locator(df, ["k", "t"]).collect()
    assert len(rows) == 4 and rows[0].part == rows[1].part and all(r.part in (0, 1) for r in rows)
    assert split_by_locator(df.limit(0), ["k"]).count() == 0
    assert {r.part for r in split_by_locator(df, ["k"], (1, 0)).collect()} == {0}
    with pytest.raises(ValueError):
        split_by_locator(df, ["k"], ())


# --------------------------------------------------------------------------- text


def test_lattice(spark, ansi):
    columns = {
        "flag": ["true", "FALSE", None],
        "whole": ["1", "-20", " 3 "],
        "number": ["1", "2.5", "1e3"],
        "day": ["2024-02-29", "", "2024-03-01"],
        "moment": ["2024-02-29", "2024-02-29 10:00:00", None],
        "no_day": ["2023-02-29", "2023-02-28", None],
        "flag_and_number": ["true", "1", None],
        "empty": [None, "", "  "],
        "text": ["a", "1", "2024-01-01"],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} string" for c in columns))
    report = infer_types(df)
    got = {r["column"]: (r["type"], r["mixed"], r["n_missing"]) for r in report.collect()}
    assert got == {
        "flag": ("boolean", False, 1),
        "whole": ("long", False, 0),
        "number": ("double", True, 0),
        "day": ("date", False, 1),
        "moment": ("timestamp", True, 1),
        "no_day": ("text", True, 1),
        "flag_and_number": ("text", True, 1),
        "empty": ("text", False, 3),
        "text": ("text", True, 0),
    }
    typed = as_inferred(df, inferred_schema(report)).collect()
    assert [r.whole for r in typed] == [1, -20, 3] and [r.number for r in typed] == [1.0, 2.5, 1000.0]
    assert str(typed[1].day) == "None" and str(typed[0].moment) == "2024-02-29 00:00:00" and typed[2].empty == "  "
    assert {r["type"] for r in infer_types(df.limit(0)).collect()} == {"text"}


def test_read_typed_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,when\n1,"a, ""b""",2024-01-02\n2,c,\n')
    df, report = read_typed_csv(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("when", "date")] and report.count() == 3
    assert [(r.id, r.name, str(r.when)) for r in df.orderBy("id").collect()] == [(1, 'a, "b"', "2024-01-02"), (2, "c", "None")]


def test_every_record_is_accounted_for(spark, tmp_path):
    text = 'a,b,c\n1,2,3\n1,2\n1,2,3,4\n"x\ny","q, ""r""",z\n,,\n5,"",7\n'
    (tmp_path / "t.csv").write_text(text)
    rows, refused = read_checked_csv(spark, str(tmp_path / "t.csv"), ["a", "b", "c"])
    assert sorted((r.a or "", r.b or "", r.c or "") for r in rows.collect()) == [("", "", ""), ("1", "2", "3"), ("5", "", "7"), ("x\ny", 'q, "r"', "z")]
    assert sorted((r.raw_record.strip(), r.n_fields, r.reason) for r in refused.collect()) == [("1,2", 2, "too few fields"), ("1,2,3,4", 4, "too many fields")]
    assert {(r.outcome, r.n) for r in account(rows, refused).collect()} == {("read", 4), ("too few fields", 1), ("too many fields", 1)}
    # columns are not shifted when only some are read
    assert sorted(r.c or "" for r in rows.select("c").collect()) == ["", "3", "7", "z"]


def test_only_good_or_only_bad_records(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "bad.csv").write_text("a,b\n1\n")
    (tmp_path / "none.csv").write_text("a,b\n")
    got = [tuple(x.count() for x in read_checked_csv(spark, str(tmp_path / f"{n}.csv"), ["a", "b"])) for n in ("good", "bad", "none")]
    assert got == [(1, 0), (0, 1), (0, 0)]


def test_field_count(spark):
    records = ["", "a", "a,b", '"a,b",c', '"a ""x,y"" b",', ",,"]
    df = spark.createDataFrame([(r,) for r in records], "r string")
    assert [r[0] for r in df.select(field_count(F.col("r"))).collect()] == [1, 1, 2, 2, 2, 3]


# --------------------------------------------------------------- stages and sinks


def test_stage_log_counts_in_the_writing_job(spark):
    df = spark.range(0, 1000, 1, 5).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("x"))
    log = StageLog(spark)
    spark.sparkContext.setJobGroup("logged", "writes")
    first = log.write("all", df)
    spark.sparkContext.setJobGroup("rest", "rest")
    second = log.write("some", first.filter("id < 10").withColumn("y", F.lit(1)))
    log.write("none", second.limit(0))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("logged")
    assert len(jobs) == 1  # the write itself
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in log.report().collect()] == [(1, "all", 1000, 2), (2, "some", 10, 3), (3, "none", 0, 3)]
    want = stage_report({"all": first, "some": second, "none": second.limit(0)})
    assert sorted(map(tuple, log.report().collect())) == sorted(map(tuple, want.collect()))
    assert {(r.stage, r.column): r.n_missing for r in log.missing().collect()}["all", "x"] == 100


def test_replaced_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("k"))
    write_stage(df, path, partition_by=["k"])
    files = lambda k: sorted((f, os.stat(f"{path}/k={k}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/k={k}") if f.endswith(".parquet"))
    before = {k: files(k) for k in range(4)}
    replace_partitions(df.filter("k = 2").select((F.col("id") + 1000).alias("id"), "k"), path, ["k"])
    replace_partitions(spark.createDataFrame([(7, 9)], "id long, k long"), path, ["k"])
    assert all(files(k) == before[k] for k in (0, 1, 3)) and files(2) != before[2]
    read = read_stage(spark, path)
    assert {r.k: (r.n, r.low) for r in read.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()} == {0: (25, 0), 1: (25, 1), 2: (25, 1002), 3: (25, 3), 9: (1, 7)}
    pruned = read.filter("k = 2")
    assert "PartitionFilters: [isnotnull(k" in pruned._jdf.queryExecution().executedPlan().toString()
    assert {f.split("/k=")[1][0] for f in pruned.inputFiles()} >= {"2"} and pruned.count() == 25
    replace_partitions(df.limit(0), path, ["k"])
    assert read_stage(spark, path).count() == 101


# ---------------------------------------------------------------- sketches and hashes


def test_merged_sketches_keep_their_bound(spark, tmp_path):
    n = 60_000
    df = spark.range(n).select((F.col("id") % 100).alias("batch"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(3) * 10).alias("x"), F.lit(None).cast("double").alias("none"))
    df = cut_lineage(df.withColumn("odd", F.when(F.col("batch") == 1, F.lit(float("nan"))).otherwise(F.col("x"))), "values")
    path = str(tmp_path / "sketches")
    for low in range(0, 100, 25):
        SK.store_sketches(SK.sketch_batches(df.filter(f"batch >= {low} AND batch < {low + 25}"), "batch", ["x", "none", "odd"]), path)
    stored = read_stage(spark, path)
    assert stored.count() == 300 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    got = {(r["column"], r.p): (r.n, r.value) for r in SK.merged_quantiles(stored, [0, 0.1, 0.5, 0.9, 1]).collect()}
    values = sorted(r.x for r in df.select("x").collect())
    assert {c for c, _ in got} == {"x", "odd"} and got["odd", 0.5][0] == n - n // 100
    for p in (0.1, 0.5, 0.9):
        size, v = got["x", p]
        low, high = sum(x < v for x in values), sum(x <= v for x in values)
        assert size == n and low - SK.rank_bound() * n <= p * n <= high + SK.rank_bound() * n
    assert got["x", 0.0][1] == values[0] and got["x", 1.0][1] == values[-1]
    assert SK.rank_bound() < 0.01


def test_hashed_categories(spark):
    df = spark.range(3000).select(F.concat(F.lit("c"), F.col("id") % 900).alias("c"), F.lit(None).cast("string").alias("gone"))
    df = df.unionByName(spark.createDataFrame([(None, None)], "c string, gone string"))
    out = FE.hashed_categories(df, ["c"], width=64)
    rows = FE.vectors_as_arrays(out, ["c_hashed"]).collect()
    assert all(len(r.c_hashed) == 64 and sum(r.c_hashed) == (r.c is not None) for r in rows)
    slot = {}
    assert all(slot.setdefault(r.c, r.c_hashed) == r.c_hashed for r in rows)
    line = FE.hash_collisions(df, ["c", "gone"], width=64).collect()
    per = {}
    for c, v in slot.items():
        if c:
            per.setdefault(tuple(v), set()).add(c)
    sizes = [len(x) for x in per.values()]
    assert tuple(line[0]) == ("c", 900, len(per), sum(s for s in sizes if s > 1), max(sizes))
    assert tuple(line[1]) == ("gone", 0, 0, 0, 0)
    wide = FE.hash_collisions(df, ["c"], width=2**20).first()
    assert wide.n_categories == 900 and wide.n_shared <= 4
