"""The row-level cleaning plan gives the same rows from a file stream as in batch."""

import shutil
import tempfile

from catalytics import fixed
from catalytics.plans import jobs
from catalytics.sources.io import read_raw_csv
from catalytics.streaming.cleaning import clean_stream, read_raw_stream, start_parquet_sink
from tests.conftest import FIXTURE_CSV


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="catalytics-stream-src-")
    out = tempfile.mkdtemp(prefix="catalytics-stream-out-")
    shutil.copy(FIXTURE_CSV, f"{src}/part-0.csv")
    batch = jobs.clean_catalogue(read_raw_csv(spark, FIXTURE_CSV, fixed.RAW_COLUMNS))
    q = start_parquet_sink(clean_stream(read_raw_stream(spark, src), 5120.0), f"{out}/data")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{out}/data")
    cols = ["App Id", "Rating", "Size_KB", "Currency", "Minimum Android"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_running_rule_counts(spark):
    from catalytics.sources.io import scratch_path
    from catalytics.streaming.cleaning import rule_counts_stream

    src = tempfile.mkdtemp(prefix="catalytics-stream-src-")
    shutil.copy(FIXTURE_CSV, f"{src}/part-0.csv")
    q = (
        rule_counts_stream(read_raw_stream(spark, src))
        .writeStream.format("memory")
        .queryName("catalytics_rule_counts")
        .outputMode("complete")
        .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    row = spark.sql("SELECT * FROM catalytics_rule_counts").first()
    assert tuple(row) == (17, 16, 14, 11, 10)
