"""Session construction for tests, benchmarks and scripts.

On a cluster the caller owns the session; operators never create one.  This
helper only fills in settings that are *unset*, so a cluster's own
``spark.checkpoint.dir`` and shuffle sizing always win.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: The JVM never compiles a method of more than 8000 bytes; with this limit Spark turns to
#: split methods there.  For wide projections, which are interpreted otherwise.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for the jobs inside the block; what was there before comes back."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "catalytics",
    driver_memory: str = "8g",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cpus = _cpus(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(2 * cpus, 8)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is.  Only a bare local session (tests) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="catalytics-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _cpus(master: str | None) -> int:
    if master and master.startswith("local[") and master[6:-1].isdigit():
        return int(master[6:-1])
    return os.cpu_count() or 4
