"""A saved tree ensemble as a relational table.

A fitted forest is a table of nodes: (tree, node, prediction, gain, rows, children,
split).  Scoring is then a join per level, and importances are one aggregation, so both
can be done, checked and explained with plain DataFrame operations, also where no model
object can be loaded.  The node table has at most ``trees * (2 ** (depth + 1) - 1)``
rows; Spark sees its size and broadcasts it while it is under its own threshold.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics.sources.io import cut_lineage


def node_table(spark: SparkSession, model_dir: str) -> DataFrame:
    """(tree, node, prediction, gain, weight, left, right, feature, threshold, goes_left).

    Read from the folder that ``save_model`` wrote.  A leaf has null children; a split on
    a category has the values that go left in ``goes_left`` and no threshold.
    """
    saved = spark.read.parquet(f"{model_dir.rstrip('/')}/data")
    inner = F.col("nodeData.leftChild") >= 0
    values = F.col("nodeData.split.leftCategoriesOrThreshold")
    ordered = F.col("nodeData.split.numCategories") < 0
    return saved.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.when(inner, F.col("nodeData.gain")).alias("gain"),
        F.col("nodeData.impurityStats")[0].alias("weight"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner & ordered, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~ordered, values).alias("goes_left"),
    )


def depth_of(nodes: DataFrame) -> int:
    """Longest way from a root to a leaf: children are looked up level by level."""
    depth, level = 0, nodes.filter("node = 0").select("tree", "left", "right")
    while True:
        below = level.select("tree", F.explode(F.array("left", "right")).alias("node")).filter("node IS NOT NULL")
        if below.isEmpty():
            return depth
        depth += 1
        level = nodes.join(below, ["tree", "node"], "left_semi").select("tree", "left", "right")


def score_by_table(rows: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """M9: (key, table_prediction) for every row; equal to the model's to the last bit.

    Each row stands at one node of each tree; a join per level moves it on by its node's
    split, and a row at a leaf stays.  The mean is taken in the order of the trees, as the
    model takes it.  ``key`` must be different for each row.
    """
    nodes = cut_lineage(nodes, "nodes")  # its true size is known to the joins
    trees = nodes.select("tree").distinct().count()
    vector = rows.schema[features].dataType
    values = F.col(f"`{features}`") if isinstance(vector, T.ArrayType) else vector_to_array(F.col(f"`{features}`"))
    at = rows.select(F.col(f"`{key}`").alias("key"), values.alias("x"))
    at = at.withColumns({"tree": F.explode(F.sequence(F.lit(0), F.lit(trees - 1))), "node": F.lit(0)})
    moves = nodes.filter("left IS NOT NULL").select("tree", "node", "left", "right", "feature", "threshold", "goes_left")
    value = F.get("x", F.col("feature"))
    left = F.when(F.col("goes_left").isNull(), value <= F.col("threshold")).otherwise(F.array_contains("goes_left", value))
    for _ in range(depth_of(nodes)):
        step = F.when(F.col("feature").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        at = at.join(moves, ["tree", "node"], "left").select("key", "x", "tree", step.alias("node"))
    ends = at.drop("x").join(nodes.select("tree", "node", "prediction"), ["tree", "node"])
    votes = F.array_sort(F.collect_list(F.struct("tree", "prediction")))  # one entry a tree
    total = F.aggregate("votes", F.lit(0.0), lambda s, v: s + v["prediction"])
    scored = ends.groupBy("key").agg(votes.alias("votes"))
    return scored.select(F.col("key").alias(key), (total / F.lit(float(trees))).alias("table_prediction"))


def importances_by_table(nodes: DataFrame) -> DataFrame:
    """(feature, importance) of the features that any tree splits on.

    Gain times the weight of the node's rows, summed per tree and feature, as a share of
    its tree; the shares of all trees are added up and normalised once more.
    """
    gains = nodes.filter("left IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    trees = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
    shares = gains.join(trees, "tree").filter("whole <> 0").groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    whole = shares.agg(F.sum("share")).first()[0]
    return shares.select("feature", (F.col("share") / F.lit(whole)).alias("importance"))


def tree_rules(nodes: DataFrame) -> DataFrame:
    """(tree, node, prediction, rule): each leaf with the conditions on the way to it."""
    step = F.when(F.col("threshold").isNotNull(), F.concat_ws(" ", F.concat(F.lit("x"), F.col("feature")), F.lit("<="), F.col("threshold").cast("string")))
    step = step.otherwise(F.concat(F.lit("x"), F.col("feature"), F.lit(" in "), F.col("goes_left").cast("string")))
    level = nodes.filter("node = 0").withColumn("rule", F.lit("").cast("string"))
    found = level.filter("left IS NULL").select("tree", "node", "prediction", "rule")
    for _ in range(depth_of(nodes)):
        inner = level.filter("left IS NOT NULL")
        ways = F.array(F.struct(F.col("left").alias("node"), step.alias("cond")), F.struct(F.col("right").alias("node"), F.concat(F.lit("not "), step).alias("cond")))
        ways = inner.select("tree", "rule", F.explode(ways).alias("way")).select("tree", "way.node", F.concat_ws(" and ", F.nullif("rule", F.lit("")), "way.cond").alias("rule"))
        level = nodes.join(ways, ["tree", "node"])
        found = found.unionByName(level.filter("left IS NULL").select("tree", "node", "prediction", "rule"))
    return found
