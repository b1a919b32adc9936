"""The whole flow with Parquet hand-overs, on the raw fixture."""

import tempfile

from catalytics import fixed
from catalytics.plans import jobs


def test_run_catalogue_pipeline(spark, raw):
    out = tempfile.mkdtemp(prefix="catalytics-pipeline-")
    res = jobs.run_catalogue_pipeline(raw, out)
    assert res["cleaned"].count() == 9
    transformed = spark.read.parquet(res["transformed"])
    assert transformed.columns == fixed.TRANSFORMED_COLUMNS
    assert transformed.count() == 9
    train = spark.read.parquet(f"{out}/ml/train")
    test = spark.read.parquet(f"{out}/ml/test")
    assert train.columns == fixed.ML_PREPARED_COLUMNS
    assert train.count() + test.count() == 9
    counted = {r.stage: (r.rows, r.columns) for r in res["log"].report().collect()}
    assert counted == {"cleaned": (9, 25), "transformed": (9, 24), "train": (train.count(), 10), "test": (test.count(), 10)}
    missing = {(r.stage, r["column"]): r.n_missing for r in res["log"].missing().collect()}
    assert missing["cleaned", "Size_KB"] == 0 == missing["cleaned", "Currency"]


def test_cleaning_reports(raw):
    cleaned = jobs.clean_catalogue(raw)
    rep = jobs.cleaning_reports(raw, cleaned)
    assert [r["rows_after"] for r in rep.rules.orderBy("step").collect()] == [16, 14, 11, 10]
    assert rep.duplicates.first()["duplicate_keys"] == 1
    assert {r["stage"]: (r["rows"], r["columns"]) for r in rep.shape.collect()} == {
        "raw": (17, 24),
        "cleaned": (9, 25),
    }
    outliers = {r["column"]: r["n_outliers"] for r in rep.outliers.collect()}
    assert list(outliers) == fixed.OUTLIER_COLUMNS
    assert outliers["Maximum Installs"] == 2
