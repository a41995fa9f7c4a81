from __future__ import annotations

import random
from collections import Counter
from math import log

import duckdb
import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import topk_search as ts
from corpusloom.llm.queries import ORACLES, QUERIES


def brute(docs, queries, k):
    words = [Counter(ts.words_of(t or "")) for _, t in docs]
    n, average = len(docs), sum(sum(w.values()) for w in words) / len(docs)
    df = Counter(t for w in words for t in w)
    out = set()
    for q, text in queries:
        asked = Counter(ts.words_of(text or ""))
        scored = []
        for (id_, _), w in zip(docs, words, strict=True):
            terms = [t for t in sorted(asked) if w[t]]
            score = sum(asked[t] * log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * ts.share(w[t], sum(w.values()), average) for t in terms)
            if terms:
                scored.append((-score, id_))
        out |= {(q, id_, rank + 1, round(-s, 9)) for rank, (s, id_) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize(("shard_docs", "block"), [(4096, 128), (16, 4), (1, 1)])
def test_against_brute_force(spark, monkeypatch, shard_docs, block):
    monkeypatch.setattr(ts, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(ts, "BLOCK", block)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 40))) for _ in range(150)]
    docs = list(enumerate([*texts, *texts[:30], "", None]))
    queries = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(12)] + [(12, None), (13, "unknown"), (14, "W1 w1, w2")]
    index, shards = ts.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    for k in (1, 7):
        got = ts.search(index, shards, spark.createDataFrame(queries, "query_id long, text string"), k).collect()
        assert {(r.query_id, r.key, r.rank, round(r.score, 9)) for r in got} == brute(docs, queries, k)


def test_documents_are_passed_over(monkeypatch):
    rng = random.Random(2)
    docs = [Counter(rng.choices(["common", "often", "x", "y", "z"], [60, 30, 1, 1, 1], k=30)) for _ in range(4000)]
    lengths = [30] * len(docs)
    blocks = ts._blocks(0, docs, lengths).to_pylist()
    by_term = {}
    for b in blocks:
        by_term.setdefault(b["term"], []).append((b["block"], b["ids"], b["counts"], b["most"], b["shortest"]))
    weights = {"common": 0.01, "often": 0.1, "x": 3.0}
    cursors = [ts._Cursor(by_term[t], w, 30.0) for t, w in sorted(weights.items())]
    scored = []

    class Counted(ts._Worst):
        def __init__(self, score, key):
            super().__init__(score, key)
            scored.append(key)

    monkeypatch.setattr(ts, "_Worst", Counted)
    ts.search_shard(cursors, list(range(len(docs))), lengths, 30.0, 5, [])
    assert len(scored) < 0.6 * len(docs)


def test_query_against_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = sorted(db.sql(ORACLES["op10_topk_search"]).fetchall())
    got = QUERIES["op10_topk_search"](spark, SF).select("query_id", "doc_id", "rank", "score")
    assert sorted(map(tuple, got.collect())) == want


def test_edges(spark, edge_docs, no_docs):
    queries = spark.createDataFrame([(1, "text words"), (2, None), (None, "first TEXT")], "query_id long, text string")
    index, shards = ts.build_index(edge_docs)
    rows = ts.search(index, shards, queries, 5).collect()
    assert {r.query_id for r in rows} == {1, None}
    assert [r.key for r in sorted((r for r in rows if r.query_id is None), key=lambda r: r["rank"])][:3] == [1, 2, 2]
    index, shards = ts.build_index(no_docs)
    assert ts.search(index, shards, queries, 5).collect() == []
