"""Scans, sinks and SQL binding.

* Raw delimited text is read with an explicit all-string schema: type
  inference costs an extra full pass and mistypes values such as ``1.0E7``;
  typing is done afterwards by ``catalytics.functions.parse`` with
  ANSI-safe expressions.
* Parquet is the hand-over format between stages; scans keep column pruning
  and predicate pushdown because nothing here forces a projection of all
  columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics.session import ensure_checkpoint_dir


def raw_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    *,
    header: bool = True,
    escape: str = '"',
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row, every column as string.

    ``escape='"'`` makes doubled quotes inside quoted fields parse as one
    quote instead of shifting later columns.  Non-multiline CSV stays
    splittable, so a large file is read by many tasks.
    """
    return (
        spark.read.schema(raw_schema(columns))
        .option("header", header)
        .option("escape", escape)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan of a staged table."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one of the driver's tables in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_stage(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """S3: Parquet sink, overwrite by default.

    ``partition_by`` lets a large stage be laid out by a low-cardinality key
    so later filters on it prune whole directories.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """S3: overwrite only the partitions that ``df`` has rows for; all others stay as they are.

    The rows are dealt by the partition's columns and a salt, so that a partition is a few
    files, and a hot one is not written by a single task.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in partition_by]), F.lit(8))
    dealt = df.repartition(*[F.col(f"`{c}`") for c in partition_by], salt) if len(df.columns) > len(partition_by) else df
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


#: A compressed text file is read by one task: records of one file.
FILE_ROWS = 500_000


def write_csv(df: DataFrame, path: str, *, header: bool = True, escape: str = '"', compression: str = "gzip") -> str:
    """Delimited-text sink (the inverse of ``read_raw_csv``); values are written
    verbatim (the writer's default whitespace trimming is turned off).  Text is
    compressed, in files of bounded size because a compressed file isn't split."""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("compression", compression)
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


_SCRATCH: list[tuple[str, str]] = []  # (application id, folder) created by this process


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/catalytics-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark.sparkContext.applicationId, path))
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder this process created for the session.

    Call it when the session's work is finished (frames returned earlier may
    still read these folders).  Returns the number of folders removed.
    """
    app = spark.sparkContext.applicationId
    removed = 0
    for entry in [e for e in _SCRATCH if e[0] == app]:
        _SCRATCH.remove(entry)
        removed += int(drop_stage(spark, entry[1]))
    return removed


def sql_query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """S4+S5: run SQL text over DataFrames bound by name.

    ``spark.sql(text, t=df)`` binds ``{t}`` references to the given frames
    without registering session-global views, so concurrent callers cannot
    clobber one another's names.
    """
    return spark.sql(text, **frames)


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet under the session's shared checkpoint folder.

    Used where a stage is consumed by several later jobs: the written table
    survives executor loss (unlike a local checkpoint) and re-reading it keeps
    column pruning and pushdown.  The folder comes from ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name or "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def staged_path(df: DataFrame) -> str | None:
    """The folder a ``cut_lineage`` frame reads from (None for other frames)."""
    files = df.inputFiles()
    if not files:
        return None
    first = files[0]
    idx = first.find("/catalytics-")
    if idx < 0:
        return None
    end = first.find("/", idx + 1)
    return first if end < 0 else first[:end]


def drop_stage(spark: SparkSession, path: str) -> bool:
    """Delete a folder this package wrote under the checkpoint folder (via the
    cluster's Hadoop FileSystem, so it works for any shared store)."""
    if "/catalytics-" not in path:
        raise ValueError(f"refusing to delete a path this package did not create: {path}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))


def save_model(model, path: str) -> str:
    """Persist a fitted MLlib model or pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind: str = "forest"):
    """Load what ``save_model`` wrote (``forest`` or ``pipeline``)."""
    if kind == "pipeline":
        from pyspark.ml import PipelineModel

        return PipelineModel.load(path)
    from pyspark.ml.regression import RandomForestRegressionModel

    return RandomForestRegressionModel.load(path)
