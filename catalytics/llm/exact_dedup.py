"""Exact deduplication by a stateful stream (operator 8); built-in functions only.

Texts are equal when identical without white space.  Each document becomes a
fingerprint: the SHA-256 of that normal form, its id (a stable identifier), its
length in code points, and a content locator (file and row it can be read at).
The fingerprints run through a Structured Streaming aggregation keyed by digest.
Its state lives on disk (RocksDB, backed by the shared checkpoint folder), has no
watermark and so never expires: a stream that goes on with the same checkpoint
knows every digest it ever saw.  The final state is read with Spark's state reader.

A digest seen twice is a hit, and hits are compared by their full bytes: per digest
the least and the greatest normal form must be the same text.  That is an
aggregation with map-side combine, so a group with a third of all rows costs no
task more than its own input.  Texts that share a digest and differ are grouped by
the text itself.

Defined results: a null text counts as empty, so null, empty and blank texts are one
group.  A null doc_id loses every tie.  Of repeated rows (same id, same text) the
one with the greatest locator stays.  An empty table gives an empty result.  Only id
and text are read, so clashing extra columns do no harm.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.llm.common import WHITE, cut_lineage, free_name, scratch_path, settings, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normal_form(text: str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def digest_of(normal: Column, bits: int = 256) -> Column:
    """Lower-case hex SHA-256; ``bits`` below 256 (tests) cut it so that texts collide."""
    return F.substring(F.sha2(normal.cast("binary"), 256), 1, bits // 4)


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a locator (file path, row in it) under a free name, and that name.

    A frame that isn't a plain file scan is written to the shared folder first.
    """
    name = free_name(docs, "locator")
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row"))), name
    except AnalysisException:
        staged = cut_lineage(docs, "located")
        meta = staged.metadataColumn("_metadata")
        return staged.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row"))), name


def fingerprints(docs: DataFrame, locator: str, bits: int = 256) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text_or_empty()).cast("long").alias("n_points"),
        digest_of(normal_form(), bits).alias("digest"),
        F.col(locator).alias("locator"),
    )


def _best() -> Column:
    # ~x falls as x rises, and a null is least: the longest text, then the smallest id
    return F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("inverse_id"), "locator"))


def _disk_backed(spark: SparkSession):
    """RocksDB as state store, without room set aside on disk for every partition; all stores
    of an executor share a bounded memory, and go soon after the stream has ended."""
    store = "spark.sql.streaming.stateStore."
    bounded = {"boundedMemoryUsage": "true", "maxMemoryUsageMB": "96", "allowFAllocate": "false"}
    wanted = {store + "providerClass": ROCKSDB, store + "maintenanceInterval": "5s"}
    return settings(spark, wanted | {f"{store}rocksdb.{k}": v for k, v in bounded.items()})


def run_stream(spark: SparkSession, folder: str, checkpoint: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Feed the fingerprint files of ``folder`` that are new to ``checkpoint`` into its
    state; the state afterwards: digest, group_size, best."""
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    seen = source.parquet(folder).groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), _best().alias("best"))
    with _disk_backed(spark):
        writer = seen.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        keys = state.schema["value"].dataType.names
        return state.select(
            F.col("key.digest").alias("digest"),
            F.col("value").getField(keys[0]).alias("group_size"),
            F.col("value").getField(keys[1]).alias("best"),
        )


def collisions(docs: DataFrame, state: DataFrame, bits: int = 256) -> DataFrame:
    """Digests whose documents differ in their full bytes."""
    hits = state.filter("group_size > 1").select("digest")
    normal = docs.select(digest_of(normal_form(), bits).alias("digest"), normal_form().alias("normal"))
    spread = normal.join(hits, "digest", "left_semi").groupBy("digest")
    return spread.agg(F.min("normal").alias("low"), F.max("normal").alias("high")).filter("low <> high").select("digest")


RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256", "locator")


def classes(docs: DataFrame, bits: int = 256) -> tuple[DataFrame, DataFrame, str]:
    """One row per document (RESULT); also ``docs`` with its locator and that column's name."""
    spark = docs.sparkSession
    docs, name = located(docs)
    folder = scratch_path(spark, "fingerprints")
    fingerprints(docs, name, bits).write.parquet(folder)
    prints = spark.read.parquet(folder)
    state = cut_lineage(run_stream(spark, folder, scratch_path(spark, "digest-state"), prints.schema), "digests")
    # hits are joined and aggregated by the same key: let the join split a hot one all the same
    with settings(spark, {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}):
        clash = cut_lineage(collisions(docs, state, bits), "collisions")

    sound = prints.join(state.join(clash, "digest", "left_anti"), "digest").withColumn("text_sha256", F.col("digest"))
    if not clash.isEmpty():
        full = docs.select(F.col(name).alias("locator"), digest_of(normal_form(), bits).alias("digest"), normal_form().alias("normal"))
        apart = full.join(clash, "digest", "left_semi").join(prints.drop("digest"), "locator")
        groups = apart.groupBy("normal").agg(F.count(F.lit(1)).alias("group_size"), _best().alias("best"))
        apart = apart.join(groups, "normal").withColumn("text_sha256", digest_of(F.col("normal"), bits))
        sound = sound.select(*apart.drop("normal").columns).unionByName(apart.drop("normal"))
    rows = sound.select(
        "doc_id",
        F.bitwise_not(F.col("best.inverse_id")).alias("keep_id"),
        "group_size",
        (F.col("locator") == F.col("best.locator")).alias("kept"),
        "text_sha256",
        "locator",
    )
    return rows, docs, name


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    columns = docs.columns
    rows, docs, name = classes(docs)
    kept = rows.filter("kept").select(F.col("locator").alias(name))
    return docs.join(kept, name, "left_semi").select(*columns)


__all__ = ["classes", "collisions", "fingerprints", "keep_first", "run_stream"]
