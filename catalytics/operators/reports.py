"""Reports: shape per stage, duplicate keys, IQR outliers.

Each report is a small DataFrame computed by Spark; nothing is removed from
the data (duplicates and outliers are detected, never dropped).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.operators.quantiles import quantile_values
from catalytics.sources.io import scratch_path, write_stage


def stage_report(stages: dict[str, DataFrame]) -> DataFrame:
    """A1: (stage, rows, columns) for each named DataFrame, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("step"),
            F.lit(name).alias("stage"),
            F.col("rows"),
            F.lit(len(df.columns)).alias("columns"),
        )
        for i, (name, df) in enumerate(stages.items(), start=1)
    ]
    return reduce(DataFrame.unionByName, parts)


class StageLog:
    """A1 without a job of its own: rows are counted by the job that writes the stage.

    ``write`` stores a stage as Parquet under ``spark.checkpoint.dir`` and observes its rows,
    and its missing values per column, in the task that writes them, which is the job's
    last stage: a retried task counts once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.lines: list[tuple[int, str, int, int, dict[str, int]]] = []

    def write(self, name: str, df: DataFrame, path: str | None = None) -> DataFrame:
        """The stage as written, read back."""
        seen = Observation()
        missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
        path = path or scratch_path(self.spark, "logged-stage")
        write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows"), *missing), path)
        got = seen.get
        nulls = {c: int(got[f"m{i}"]) for i, c in enumerate(df.columns)}
        self.lines.append((len(self.lines) + 1, name, int(got["rows"]), len(df.columns), nulls))
        return self.spark.read.schema(df.schema).parquet(path)  # known, so no job looks for it

    def report(self) -> DataFrame:
        """(step, stage, rows, columns): what ``stage_report`` gives, from the log."""
        rows = [line[:4] for line in self.lines]
        return self.spark.createDataFrame(rows, "step int, stage string, rows long, columns int")

    def missing(self) -> DataFrame:
        """(step, stage, column, n_missing) of every stage."""
        rows = [(step, stage, c, n) for step, stage, _, _, nulls in self.lines for c, n in nulls.items()]
        return self.spark.createDataFrame(rows, "step int, stage string, column string, n_missing long")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A2: keys seen more than once, with their row count."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def duplicate_key_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A2: number of keys seen more than once (one row)."""
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def outlier_report(
    df: DataFrame,
    columns: Sequence[str],
    k: float = fixed.OUTLIER_FENCE,
    relative_error: float = fixed.OUTLIER_QUANTILE_ERROR,
) -> DataFrame:
    """IQR fences and the number of rows strictly outside them, per column.

    Two jobs for any number of columns: one for the quartiles (a bounded
    sketch, or the exact distributed method when ``relative_error`` is 0),
    one aggregation that counts rows outside the fences.  The fences are two
    numbers per column, so they are literals of the plan.
    """
    quartiles = quantile_values(df, columns, [0.25, 0.75], relative_error)
    fences, counts = [], []
    for i, c in enumerate(columns):
        q1, q3 = quartiles[c]
        known = q1 is not None and q3 is not None
        iqr = q3 - q1 if known else None
        lower, upper = (q1 - k * iqr, q3 + k * iqr) if known else (None, None)
        fences.append((c, q1, q3, iqr, lower, upper))
        v = F.col(f"`{c}`").cast("double")
        outside = (v < F.lit(lower)) | (v > F.lit(upper)) if known else F.lit(False)
        counts.append(F.count_if(outside).alias(f"n{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(x).cast("double").alias(n) for n, x in zip(("q1", "q3", "iqr", "lower", "upper"), numbers, strict=True)],
            F.col(f"n{i}").alias("n_outliers"),
        )
        for i, (c, *numbers) in enumerate(fences)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))
