"""Postings that follow upserts: an index of segments with tombstones, merged on reading.

A segment holds the postings of the documents of one load and the list of all keys that the load
touched, deleted ones too. A document's postings count only in the last segment that touched
it. So a load costs what its own documents cost; texts indexed before are not read again, and
corpus totals, which come from the postings, stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.tokens import postings_and_lengths
from corpusloom.session import claim_path, matching_paths

SEGMENT = "segment"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Segments that are complete, in order."""
    return [int(p.rsplit("/", 1)[1].partition("=")[2]) for p in matching_paths(spark, f"{root}/done/{SEGMENT}=*")]


def add_segment(
    docs: DataFrame, root: str, text: str, deleted: DataFrame | None = None, analyzer: str = "simple", key: str = "doc_id"
) -> int:
    """Index ``docs``, unique by key, as the next segment; keys of ``deleted`` are gone from it on. Returns its number.

    A number is taken once, whoever asks, and a segment counts once it is complete.
    """
    spark = docs.sparkSession
    taken = matching_paths(spark, f"{root}/taken/*")
    number = int(taken[-1].rsplit("/", 1)[1]) + 1 if taken else 0
    while not claim_path(spark, f"{root}/taken/{number:08d}", ""):
        number += 1
    part = f"{SEGMENT}={number:08d}"
    touched = docs.select(key) if deleted is None else docs.select(key).unionByName(deleted.select(key))
    touched.filter(F.col(key).isNotNull()).distinct().write.parquet(f"{root}/keys/{part}")
    postings_and_lengths(docs, text, analyzer, key).write.parquet(f"{root}/postings/{part}")
    claim_path(spark, f"{root}/done/{part}", "")
    return number


def _read(spark: SparkSession, root: str, kind: str, numbers: list[int]) -> DataFrame:
    paths = [f"{root}/{kind}/{SEGMENT}={n:08d}" for n in numbers]
    return spark.read.option("basePath", f"{root}/{kind}").parquet(*paths).withColumn(SEGMENT, F.col(SEGMENT).cast("int"))


def live_postings(spark: SparkSession, root: str, key: str = "doc_id") -> DataFrame:
    """``(term, key, tf, doc_len)`` of the current documents, in the form that ``bm25_topk`` takes.

    The first segment, usually the bulk, lends no keys: only keys that a later segment touched
    are looked up, so the join's small side is as small as what has changed since.
    """
    numbers = _numbers(spark, root)
    if not numbers:
        raise RuntimeError(f"{root}: no segment is complete")
    postings = _read(spark, root, "postings", numbers)
    if len(numbers) > 1:
        last = _read(spark, root, "keys", numbers[1:]).groupBy(key).agg(F.max(SEGMENT).alias("_last"))
        postings = postings.join(last, key, "left").filter(F.col("_last").isNull() | (F.col(SEGMENT) == F.col("_last")))
    return postings.select("term", key, "tf", "doc_len")


def merge_segments(spark: SparkSession, root: str, target: str, key: str = "doc_id") -> None:
    """Write the current postings to ``target`` as one segment, without what has been replaced or deleted."""
    part = f"{SEGMENT}={0:08d}"
    live = live_postings(spark, root, key)
    claim_path(spark, f"{target}/taken/{0:08d}", "")
    live.write.parquet(f"{target}/postings/{part}")
    live.filter(F.col("term").isNull()).select(key).write.parquet(f"{target}/keys/{part}")
    claim_path(spark, f"{target}/done/{part}", "")
