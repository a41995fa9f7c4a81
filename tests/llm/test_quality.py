from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import quality
from corpusloom.llm.queries import QUERIES

SF_LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_LARGER}/labels.parquet")


@pytest.fixture(scope="module")
def model(spark, labels):
    return quality.train(spark.read.parquet(f"{SF_LARGER}/documents.parquet"), labels)


def test_held_out_accuracy(spark, labels):
    rows = {r.doc_id: r for r in QUERIES["op7_quality"](spark, SF_LARGER).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    gold = {r.doc_id: r.quality for r in labels.collect() if rows[r.doc_id].held_out}
    good = [rows[i].predicted for i, q in gold.items() if q]
    bad = [rows[i].predicted for i, q in gold.items() if not q]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_training_leaves_out_held_out_labels(spark, labels):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    seen = quality.train(documents, labels)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality")
    assert (quality.train(documents, flipped).vectors == seen.vectors).all()


def test_edges(edge_docs, no_docs, model, labels):
    rows = quality.classify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows if r.doc_id is not None}
    assert by_id[3] == by_id[4] == by_id[7] and by_id[1] == by_id[2]
    assert quality.classify(no_docs, model).collect() == []
    untrained = quality.train(no_docs, labels)
    assert {r.score for r in quality.classify(edge_docs, untrained).collect()} == {0.5}
    assert quality.train(edge_docs, labels.limit(0)).bias.tolist() == [0, 0]


def test_words_count_by_one_number(model):
    texts = ["a few words of text, a few", "", None, "Words words"]
    assert np.allclose(model.score(texts, {}), model.score(texts[::-1], {})[::-1])
    words, _, shape = quality.document_features(texts[0])
    owner, rows = quality.table_rows(list(words))
    share = np.array(list(words.values()), dtype=float)[owner]
    hidden = model._means(rows, share / share.sum(), np.array([zlib.crc32(s.encode()) % quality.BUCKETS for s in shape]))
    want = quality._softmax((hidden @ model.output + model.bias)[None])[0, 1]
    assert np.isclose(model.score(texts[:1], {})[0], want)
