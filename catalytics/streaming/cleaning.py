from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalytics import fixed
from catalytics.functions.parse import parse_size_kb
from catalytics.operators.missing import fill_constants, replace_sentinel
from catalytics.operators.rules import catalogue_rules, enforce_rules, require_present
from catalytics.plans.jobs import type_catalogue
from catalytics.sources.io import raw_schema, scratch_path


def read_raw_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(raw_schema(fixed.RAW_COLUMNS))
        .option("header", True)
        .option("escape", '"')
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def clean_stream(raw: DataFrame, size_median: float | None) -> DataFrame:
    """E1 without the median computation: typed, validated, filled rows."""
    valid = enforce_rules(type_catalogue(raw), catalogue_rules()).withColumn(
        "Size_KB", parse_size_kb(F.col("Size"))
    )
    if size_median is not None:
        valid = valid.na.fill({"Size_KB": float(size_median)})
    valid = replace_sentinel(fill_constants(valid, fixed.TEXT_FILLS), "Currency")
    return require_present(valid, fixed.REQUIRED_COLUMNS)


def rule_counts_stream(raw: DataFrame) -> DataFrame:
    """Running rows-passed counts per rule (a stateful global aggregation)."""
    typed = type_catalogue(raw)
    passed = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    for name, pred in catalogue_rules():
        passed = passed & F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(passed).alias(f"after_{name}"))
    return typed.agg(*aggs)


def start_parquet_sink(
    df: DataFrame, out_path: str, checkpoint: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append to Parquet with a checkpoint under the shared checkpoint folder
    (exactly-once file sink; restarts resume from the checkpoint)."""
    spark = df.sparkSession
    writer = (
        df.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
