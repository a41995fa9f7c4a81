"""Sharding by a two-pass external shuffle, in DataFrame operations only.

First pass: seeded hashes scatter the records of each shard uniformly over buckets that fit
into a task's memory. Second pass: each bucket is shuffled by Fisher-Yates and written. The
order of a shard is the order of its buckets, and inside them the shuffled order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import drop_clashing, materialize, text_or_empty

#: Input bytes that a bucket holds on average. A task holds one bucket at a time. Take more on
#: executors with more memory: the table of bucket offsets has one row per bucket.
BUCKET_BYTES = 8 << 20
OUTPUT = ("law", "shard", "slot", "grown_shard")


def shard_of(key: Column, n_shards: int, seed: int) -> Column:
    """Rendezvous hashing: the shard whose hash with the key is greatest.

    Key and shard count alone decide. A further shard takes keys only into itself, as the
    hashes of the others stay the same. Null is a key like any other.
    """
    weights = F.array(*(F.xxhash64(F.lit(seed), F.lit(i), key) for i in range(n_shards)))
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def shuffle_into_shards(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_shards: int = 8,
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with its shard, its slot there and its shard if there were one more.

    Slots count from 0 without gaps in each shard. Rows of one key share a shard, but are
    scattered over its buckets by their place in the input, so that a key with a third of all
    rows, or equal rows, make no large bucket. Null texts count as empty; an empty table gives
    an empty result; input columns named law, shard, slot or grown_shard are replaced.
    """
    rows = drop_clashing(docs, *OUTPUT)
    placed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"),
        (F.octet_length(text_or_empty(text)) + 1).alias("size"),
        shard_of(F.col(f"`{key}`"), n_shards, seed).alias("shard"),
    )
    # At most n_shards rows reach the driver.
    held = {r.shard: r.bytes for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    n_buckets = [max(1, -(-held.get(i, 0) // bucket_bytes)) for i in range(n_shards)]
    buckets = F.array(*map(F.lit, n_buckets))
    scattered = placed.select(
        "row",
        "shard",
        F.pmod(
            F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.element_at(buckets, F.col("shard") + 1)
        ).alias("bucket"),
    ).repartition(sum(n_buckets), "shard", "bucket")  # a task holds few buckets
    shuffled = (
        scattered.groupBy("shard", "bucket")
        .agg(F.collect_list("row").alias("held"))
        .select("shard", "bucket", F.posexplode(F.shuffle("held", seed)).alias("place", "row"))
    )
    # Written once: the order is then fixed, whatever is read again or lost later.
    written = materialize(shuffled, "shards")
    order = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Written too, so that Spark knows its size (a row per bucket) and need not move the texts to join it.
    offsets = materialize(
        written.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before")),
        "offsets",
    )
    return written.join(offsets, ["shard", "bucket"]).select(
        "row.*",
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("place")).alias("slot"),
        shard_of(F.col(f"row.`{key}`"), n_shards + 1, seed).alias("grown_shard"),
    )


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder per shard, its files in the order of the slots."""
    shards.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
