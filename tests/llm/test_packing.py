from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.queries import QUERIES, VOCABULARY

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def check_pieces(rows, texts):
    """Every token once, offsets gapless, sequences full or of a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for id_, text in texts.items():
        want = ids_of(text).tobytes()
        pieces = sorted(by_doc.pop(id_), key=lambda r: r.start)
        assert b"".join(bytes(p.ids) for p in pieces) == want
        assert all(p.doc_tokens == len(want) // 4 and len(p.ids) == 4 * p.length for p in pieces)
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
    assert not by_doc
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        filled = np.cumsum([0, *(p.length for p in pieces)]).tolist()
        assert [p.offset for p in pieces] == filled[:-1]
        assert filled[-1] <= 1024 and filled[-1].bit_count() == 1


@pytest.mark.parametrize("cut", [0, packing.CUT, 10**9])
def test_round_trip(spark, cut):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    check_pieces(packing.pack(documents, VOCABULARY, cut=cut).collect(), texts)


def test_query(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: ids_of(r.text) for r in documents.collect()}
    for r in QUERIES["op5_packing"](spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())


def test_edges(edge_docs, no_docs):
    rows = packing.pack(edge_docs, VOCABULARY).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(r.text)) for r in edge_docs.collect())
    assert [r.doc_tokens for r in rows if r.doc_id == 3] == [1] and any(r.doc_id is None for r in rows)
    assert packing.pack(no_docs, VOCABULARY).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    encoding = packing.load_encoding(VOCABULARY)
    assert encoding.encode(text, allowed_special="all") == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_least_sum_of_squares():
    rng = np.random.default_rng(6)
    packer = packing.Packer(32, 10**9)
    for i in range(800):
        size = int(rng.integers(1, 32))
        before = packer.counts.copy()
        level, growth = packer.level_for(size)
        assert level == 0 or before[level] > 0

        def total(at, before=before, size=size):
            after = before.copy()
            after[at] -= at > 0
            after[at + size] += at + size < 32
            return int((after**2).sum())

        options = [at for at in range(32 - size + 1) if at == 0 or before[at] > 0]
        assert total(level) == min(map(total, options)) == int((before**2).sum()) + growth
        list(packer.add(i, array("I", [1] * size)))


def test_the_rule_places_nearly_all_pieces(spark):
    """One task with all documents of a larger table: few pieces are moved at the end."""
    encoding = packing.load_encoding(VOCABULARY)
    packer, pieces = packing.Packer(packing.WINDOW, packing.CUT), 0
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect():
        ids = array("I", [*encoding.encode(r.text or "", allowed_special="all"), 0])
        pieces += sum(map(len, packer.add(r.doc_id, ids)))
    pieces += sum(map(len, packer.finish()))
    assert packer.moved < 0.05 * pieces and packer.placed > 0.9 * pieces


@pytest.mark.parametrize("sizes", [[600], [600, 601, 602], [513], [1023], list(range(500, 1024))])
def test_windows_stay_few_whatever_the_sizes(sizes):
    """Documents that never fit together: they are cut rather than left in windows of their own."""
    packer, windows = packing.Packer(1024, packing.CUT), []
    for i in range(6000):
        windows += packer.add(i, array("I", [1] * sizes[i % len(sizes)]))
        assert packer.counts.max() <= packing.CUT + 2
    assert packer.counts.sum() < 2500
    windows += packer.finish()
    total = sum(sizes[i % len(sizes)] for i in range(6000))
    assert sum(len(p[2]) for w in windows for p in w) == total and len(windows) <= total // 1024 + 11
