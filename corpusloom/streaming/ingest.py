"""Incremental ingest of custom documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.schemas import CUSTOM_DOC
from corpusloom.session import matching_paths
from corpusloom.sources.ndjson import split_custom_docs
from corpusloom.sources.records import latest_by_key, union_custom

DELTA_KEY = "batch_id"
#: What decides between versions of one document: later batch, later file, later line.
ORDER = [DELTA_KEY, "file_time", "file", "block", "place"]


def stream_custom_docs(
    spark: SparkSession,
    source: str,
    deltas: str,
    checkpoint: str,
    files_per_batch: int = 100,
    now: Column | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Read new JSON-lines files, store each micro-batch as one delta and its refused lines apart, then stop.

    A batch writes only its own rows, under its own batch id, so the cost does not grow with
    the corpus and a repeated batch replaces itself. Merging by key needs no watermark.
    Refused lines go to ``rejects``, beside the deltas by default.
    """
    refused = rejects or f"{deltas.rstrip('/')}-rejected"
    raw = (
        spark.readStream.schema(CUSTOM_DOC)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("file_time"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("place", F.monotonically_increasing_id())
        accepted, rejected = split_custom_docs(placed, now, carry=ORDER[1:])
        accepted.write.mode("overwrite").parquet(f"{deltas}/{DELTA_KEY}={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{refused}/{DELTA_KEY}={batch_id}")

    return (
        raw.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _deltas(spark: SparkSession, deltas: str) -> DataFrame | None:
    """All stored versions; none before the first batch."""
    return spark.read.parquet(deltas) if matching_paths(spark, f"{deltas}/{DELTA_KEY}=*") else None


def read_deltas(spark: SparkSession, deltas: str) -> DataFrame:
    """The newest version of every streamed document."""
    found = _deltas(spark, deltas)
    if found is None:
        return spark.createDataFrame([], CUSTOM_DOC).drop("_corrupt")
    return latest_by_key(found, ["page_id"], ORDER).drop(*ORDER)


def merge_deltas(base: DataFrame, deltas: str) -> DataFrame:
    """The corpus with all streamed documents merged in; before the first batch, the corpus."""
    found = _deltas(base.sparkSession, deltas)
    return base if found is None else union_custom(base, found, ORDER)


def compact_deltas(spark: SparkSession, deltas: str, target: str) -> None:
    """Write the newest version of every document to ``target`` as one delta, with its place in the order.

    A stream that goes on writes to ``target`` from then on; later batches have greater ids, so
    they still win.
    """
    found = _deltas(spark, deltas)
    if found is not None:
        latest = latest_by_key(found, ["page_id"], ORDER)
        last = found.agg(F.max(DELTA_KEY)).first()[0]
        latest.drop(DELTA_KEY).write.parquet(f"{target}/{DELTA_KEY}={last}")
