from __future__ import annotations

import numpy as np
import pytest
import xxhash
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import simhash
from corpusloom.llm.components import components
from corpusloom.llm.queries import QUERIES


def brute_print(text, shingle):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, threshold=4):
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j]).bit_count() <= threshold and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def test_query(spark):
    rows = sorted(QUERIES["op2_simhash"](spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    prints = [brute_print(t, 4) for _, t in docs]
    roots = brute_roots(prints)
    assert [tuple(r) for r in rows] == [(d, f"{p:016x}", docs[i][0]) for (d, _), p, i in zip(docs, prints, roots, strict=True)]


@pytest.mark.parametrize("part", [4, simhash.PART])
def test_dense_groups_of_fingerprints(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = np.random.default_rng(3)
    prints = {0, 1, 3, 7, 15, 31, 63}
    for _ in range(12):
        centre = int(rng.integers(0, 2**63))
        prints |= {centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False)) for _ in range(40)}
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long")
    got = {r.node: r.root for r in components(simhash.link_prints(df)).collect()}
    roots = brute_roots(prints)
    for i, p in enumerate(prints):
        for j in range(i):
            same = got.get(int(np.uint64(p).view(np.int64)), p) == got.get(int(np.uint64(prints[j]).view(np.int64)), prints[j])
            assert same == (roots[i] == roots[j])


def test_anchors_bring_near_prints_together():
    rng = np.random.default_rng(8)
    for _ in range(2000):
        a = np.uint64(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        found, index = simhash.anchors(np.array([a, b], dtype=np.uint64))
        assert set(found[index == 0]) & set(found[index == 1])
        assert len(found) <= 2 * 27


def test_edges(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs, keep_text=True).collect()
    assert len(rows) == edge_docs.count() and {r.kept for r in rows} == {"mine"}
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[3].fingerprint == by_id[4].fingerprint == by_id[7].fingerprint == 0 and by_id[7].component_id == 3
    assert by_id[6].component_id == 5
    assert sorted(r.component for r in rows if r.stays) == sorted({r.component for r in rows})
    assert simhash.near_duplicates(no_docs).collect() == []


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
