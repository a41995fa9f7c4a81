from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import ball_tree as bt
from corpusloom.llm.queries import ORACLES, QUERIES


def cut(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def brute(docs, queries, k):
    words = [(id_, Counter(cut(t))) for id_, t in docs]
    n_docs, total = sum(bool(w) for _, w in words), sum(sum(w.values()) for _, w in words)
    df = Counter(t for _, w in words for t in w)
    out = []
    for q in {q for q, _ in queries}:
        asked = Counter(t for i, text in queries if i == q for t in cut(text))
        scored = []
        for id_, w in words:
            m = 25 + (75 * sum(w.values()) * n_docs) // total if total else 0
            score = sum(
                times * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * w[t]) // (1000 * w[t] + 8 * m))
                for t, times in asked.items()
                if w[t]
            )
            if score > 0:
                scored.append((-score, id_ is None, id_ or 0))
        out += [(q, rank + 1, None if none else id_, -s) for rank, (s, none, id_) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(index_of, docs, queries, k):
    index, shards = bt.build_index(docs)
    return sorted([(r.query_id, r["rank"], r.key, r.score) for r in bt.search(index, shards, queries, k).collect()], key=str)


@pytest.mark.parametrize(("shard_docs", "leaf", "per_task"), [(4096, 64, 256), (40, 4, 3), (1, 1, 256)])
def test_against_brute_force(spark, monkeypatch, shard_docs, leaf, per_task):
    monkeypatch.setattr(bt, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(bt, "LEAF", leaf)
    monkeypatch.setattr(bt, "QUERIES", per_task)
    rng = random.Random(leaf)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 60))) for _ in range(220)]
    docs = list(enumerate([*texts, *texts[:30], "", None]))
    queries = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(14)]
    queries += [(14, None), (15, "unknown"), (16, "W1 w1, w2"), (3, "w40 w41")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    for k in (1, 7):
        assert found(bt, frame, asked, k) == brute(docs, queries, k)


def test_words():
    text = "It's A-b_c 3.14 ÀÉß straße日本  x\u0085y\tz İ K"
    assert [w.decode() for w in bt.words_of(text)] == cut(text)


def test_subtrees_are_pruned_and_bounds_hold():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 3000, 400
    docs = np.repeat(np.arange(n_docs), 12)
    topic = np.repeat(rng.integers(0, 20, n_docs), 12)
    terms = np.where(rng.random(len(docs)) < 0.98, topic * 20 + np.tile(np.arange(12), n_docs), rng.integers(0, n_terms, len(docs)))
    pairs = np.unique(docs * n_terms + terms)
    docs, terms = pairs // n_terms, pairs % n_terms
    values = rng.integers(800, 1000, len(docs))
    weights = rng.integers(4000, 9000, n_terms)
    tree = bt.BallTree(docs, terms, values, weights)
    query = np.array([21, 22, 25, 27, 30, 38])
    times = np.array([1, 2, 1, 1, 1, 1])
    dense = np.zeros((n_docs, n_terms), dtype=np.int64)
    dense[docs, terms] = values
    every = (dense[:, query] * (times * weights[query])).sum(axis=1)
    bounds = tree.bounds(query, times)
    for bound, (low, end, _, _) in zip(bounds, tree.nodes, strict=True):
        assert every[tree.ids[low:end]].max() <= bound
    visited = []
    scores = tree.scores
    tree.scores = lambda leaf, *a: visited.append(leaf) or scores(leaf, *a)
    got = sorted(tree.search(query, times, weights[query], 10), key=lambda x: (-x[0], x[1]))
    assert got == sorted([(int(s), i) for i, s in enumerate(every) if s > 0], key=lambda x: (-x[0], x[1]))[:10]
    assert len(visited) < 0.7 * (len(tree.leaf_starts) - 1)


def test_query_against_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = sorted(db.sql(ORACLES["op12_lexical_search"]).fetchall())
    got = QUERIES["op12_lexical_search"](spark, SF).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect())) == want


def test_edges(spark, edge_docs, no_docs):
    queries = [(1, "text words"), (2, None), (None, "first TEXT"), (3, "x" * 70_000), (4, "ünïcödé")]
    asked = spark.createDataFrame(queries, "query_id long, text string")
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert found(bt, edge_docs, asked, 5) == brute(rows, queries, 5)
    assert found(bt, no_docs, asked, 5) == []
    assert found(bt, edge_docs, asked.limit(0), 5) == []
    assert found(bt, edge_docs.filter("text is null"), asked, 5) == []
