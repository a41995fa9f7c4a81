from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from llm_fixtures import SF, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import sharding
from corpusloom.llm.queries import QUERIES


def _slots_are_gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_all_rows_once_and_gapless(spark, edge_docs, no_docs):
    rows = sharding.shuffle_into_shards(edge_docs, bucket_bytes=4096).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in edge_docs.collect())
    assert _slots_are_gapless(rows) and {r.kept for r in rows} == {"mine"}
    assert all(isinstance(r.shard, int) for r in rows)  # the clashing column is replaced
    assert sharding.shuffle_into_shards(no_docs).collect() == []


def test_key_law(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('a', cast(id % 50 as int)) as text")
    eight = {r.doc_id: r for r in sharding.shuffle_into_shards(df).collect()}
    nine = {r.doc_id: r.shard for r in sharding.shuffle_into_shards(df, n_shards=9, bucket_bytes=100).collect()}
    assert all(r.grown_shard == nine[i] and nine[i] in (r.shard, 8) for i, r in eight.items())
    sizes = Counter(r.shard for r in eight.values())
    assert len(sizes) == 8 and min(sizes.values()) > 3000 / 8 * 0.8


def test_order_is_shuffled(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'t' as text")
    rows = sorted((r for r in sharding.shuffle_into_shards(df).collect() if r.shard == 0), key=lambda r: r.slot)
    rising = sum(a.doc_id < b.doc_id for a, b in zip(rows, rows[1:], strict=False))
    assert 0.4 < rising / len(rows) < 0.6


def test_hot_key_is_scattered(spark):
    df = spark.range(2000).selectExpr("7L as doc_id", "'same' as text")
    rows = sharding.shuffle_into_shards(df, bucket_bytes=1000).collect()
    assert len(rows) == 2000 and len({r.shard for r in rows}) == 1 and _slots_are_gapless(rows)


def test_write(spark, tmp_path):
    sharding.write_shards(QUERIES["op8_sharding"](spark, SF), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def weight(seed, shard, key):
    """The hash that one shard has with a key: a chain over the numbers' bytes."""
    h = 42
    for value, form in ((seed, "<i"), (shard, "<i"), (key, "<q")):
        h = xxhash.xxh64_intdigest(struct.pack(form, value), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_query_columns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs) and _slots_are_gapless(rows)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        weights = [weight(42, i, r.doc_id) for i in range(9)]
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == weights.index(max(weights[:8])) and r.grown_shard == weights.index(max(weights))
