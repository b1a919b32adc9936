"""Delimited text whose records are all accounted for.

A record with too few or too many fields is neither dropped nor shifted into the wrong
columns: Spark's parser marks it, and it goes to a quarantine table with its raw text and
the reason.  Line ends inside quotes belong to their field (``multiLine``: one task reads
a file as a whole, so write large inputs as many files).

``read + quarantined = records`` holds for every input; ``account`` reports it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics.sources.io import raw_schema, scratch_path

RAW = "_raw_record"


def field_count(record: Column) -> Column:
    """Number of fields of a raw record; separators inside quotes don't count."""
    plain = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.translate(plain, ",", "")) + 1


def read_checked_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    *,
    header: bool = True,
    escape: str = '"',
    multiline: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of delimited text; quarantine: (raw_record, n_fields, reason).

    The parse is written once under ``spark.checkpoint.dir``, each record with its mark, so
    both come from the same pass over all columns.  One table for both: a folder for each
    would have every row sorted by the mark before it is written.
    """
    schema = T.StructType([*raw_schema(columns), T.StructField(RAW, T.StringType(), True)])
    parsed = (
        spark.read.schema(schema)
        .options(header=header, escape=escape, multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
        .csv(path)
    )
    base = scratch_path(spark, "checked-csv")
    parsed.withColumn("refused", F.col(RAW).isNotNull()).write.mode("overwrite").parquet(base)
    # read under the schema as written: an empty side is an empty frame
    stored = spark.read.schema(T.StructType([*schema, T.StructField("refused", T.BooleanType(), True)])).parquet(base)
    rows = stored.filter(~F.col("refused")).select(*[F.col(f"`{c}`") for c in columns])
    n = field_count(F.col(RAW))
    reason = F.when(n < len(columns), "too few fields").when(n > len(columns), "too many fields").otherwise("unreadable")
    refused = stored.filter("refused").select(F.col(RAW).alias("raw_record"), n.alias("n_fields"), reason.alias("reason"))
    return rows, refused


def account(rows: DataFrame, refused: DataFrame) -> DataFrame:
    """(outcome, n): rows read, and records refused by reason."""
    kept = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("outcome"), "n")
    return kept.unionByName(refused.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))
