"""Per-session staging of the catalogue stand-in.

The source pipeline reads a raw text file once and hands a cleaned Parquet
table to every later step.  The bindings do the same: the raw-text catalogue
derived from the driver tables is written once per session and table folder
(the analogue of the raw CSV file) where a query reads it by itself, and so are the
validated rows, of which the cleaned table is a projection (fills by constants and the
median).  Both live under the session's shared ``spark.checkpoint.dir`` so they survive executor
loss, and re-reading them keeps column pruning and pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalytics import fixed
from catalytics.plans import jobs
from catalytics.plans.catalogue import raw_catalogue
from catalytics.operators.features import catalogue_features
from catalytics.session import COMPILED, settings
from catalytics.sources.io import read_stage, release_scratch, scratch_path, write_stage

_STAGED: dict[tuple[str, str, str], str | DataFrame] = {}


SOURCES = ("lineitem", "orders")
#: Rows of one application stay on one side of the train/test split.
SPLIT_KEY = "App Id"


def _state_of(spark: SparkSession, sf_dir: str) -> str:
    """Paths, sizes and modification times of the source tables' files: a
    replaced or appended table gets a new stage instead of a stale one."""
    found = []
    for name in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listStatus(path)
        found += sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files)
    return "|".join(found)


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, str, str]:
    state = _state_of(spark, sf_dir)
    return (spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')} {state}", what)


def staged_raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _key(spark, sf_dir, "raw")
    if key not in _STAGED:
        _STAGED[key] = write_stage(raw_catalogue(spark, sf_dir), scratch_path(spark, "raw-catalogue"))
    return read_stage(spark, _STAGED[key])


def raw_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalogue for a job that reads it once and writes it elsewhere: the staged
    table if this session has one, else the derivation itself, without a table in between."""
    if _key(spark, sf_dir, "raw") in _STAGED:
        return staged_raw_catalogue(spark, sf_dir)
    return raw_catalogue(spark, sf_dir)


def staged_cleaned_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _key(spark, sf_dir, "cleaned")
    if key not in _STAGED:
        _STAGED[key] = jobs.clean_catalogue(raw_source(spark, sf_dir))
    return _STAGED[key]


def staged_ml_sets(
    spark: SparkSession, sf_dir: str, refresh: bool = False
) -> tuple[DataFrame, DataFrame]:
    """E4 output (prepared train and test), written like the source pipeline
    writes its two ML Parquet tables; reused by later steps of the session
    unless ``refresh`` asks for a new run."""
    key = _key(spark, sf_dir, "ml")
    if refresh or key not in _STAGED:
        drop = [c for c in fixed.REDUCTION_DROP if c != SPLIT_KEY]
        featured = catalogue_features(jobs.reduce_columns(staged_cleaned_catalogue(spark, sf_dir), drop))
        train, test, _ = jobs.prepare_ml(featured, split_key=SPLIT_KEY, exact_median=True)
        base = scratch_path(spark, "ml-sets")
        with settings(spark, COMPILED):
            write_stage(train, f"{base}/train")
            write_stage(test, f"{base}/test")
        _STAGED[key] = base
    base = _STAGED[key]
    return read_stage(spark, f"{base}/train"), read_stage(spark, f"{base}/test")


def release_session(spark: SparkSession) -> int:
    """End of a session's work: forget its staged tables and delete every
    scratch folder this process wrote for it.  Returns folders removed."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _STAGED if k[0] == app]:
        del _STAGED[key]
    return release_scratch(spark)
