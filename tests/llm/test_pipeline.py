from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
import numpy as np
import pytest
from llm_fixtures import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F
from test_packing import check_pieces

from corpusloom.llm import decontamination, quality, simhash, suffix_dedup

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """What each stage left, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in cp.STAGES:
        stage(spark, out[-1], SF).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_rows(staged):
    assert all(df.columns == COLUMNS for df in staged[:-1])
    ids = [set(rows(df)) for df in staged[:-1]]
    assert all(a >= b for a, b in zip(ids, ids[1:], strict=False)) and ids[3] == ids[2]


def test_quality_stage(spark, staged):
    model = quality.train(staged[0], spark.read.parquet(f"{SF}/labels.parquet"))
    docs = sorted(rows(staged[0]).values())
    want = {d.doc_id for d, s in zip(docs, model.score([d.text for d in docs], {}), strict=True) if s >= 0.7}
    assert set(rows(staged[1])) == want


def test_near_duplicate_stage(staged):
    before, after = rows(staged[1]), rows(staged[2])
    ids = sorted(before)
    prints = np.array([simhash.fingerprint(before[i].text, 4) for i in ids], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4
    want, left = set(), set(range(len(ids)))
    while left:
        group = [min(left)]
        left -= set(group)
        want.add(ids[group[0]])
        while group:
            found = left & set(np.flatnonzero(near[group.pop()]).tolist())
            left -= found
            group += found
    assert set(after) == want and len(want) < len(ids)


def brute_passages(texts, n, unit):
    """Per text which of its units are inside a run of ``n`` of them that also starts anywhere else."""
    units = [unit(t) for t in texts]
    places = Counter(hash(u[i : i + n]) for u in units for i in range(len(u) - n + 1))
    out = []
    for u in units:
        hit = np.zeros(len(u), dtype=bool)
        for i in range(len(u) - n + 1):
            if places[hash(u[i : i + n])] > 1:
                hit[i : i + n] = True
        out.append(hit)
    return out


def test_repeats_stage(staged):
    """Passages of 51 words go up to the next word; strings of 400 bytes go where one may hold fewer words."""
    before, after = rows(staged[2]), rows(staged[3])
    ids = sorted(before)
    data = [before[i].text.encode() for i in ids]
    words = brute_passages(data, cp.PASSAGE_WORDS, lambda t: tuple(t.split()))
    removed = 0
    wordy = []
    for text, hit in zip(data, words, strict=True):
        starts, ends = suffix_dedup.word_ranges(text)
        low = np.arange(max(0, len(text) - 399))
        inside = np.searchsorted(ends, low + 400, side="right") - np.searchsorted(starts, low)
        wordy.append(inside.min(initial=cp.PASSAGE_WORDS) < cp.PASSAGE_WORDS)
        assert len(hit) == len(starts)
    strings = dict(zip(np.flatnonzero(wordy).tolist(), brute_passages([data[i] for i in np.flatnonzero(wordy)], 400, bytes), strict=True))
    for at, (i, text, hit) in enumerate(zip(ids, data, words, strict=True)):
        starts = np.append(suffix_dedup.word_ranges(text)[0], len(text))
        gone = strings.get(at, np.zeros(len(text), dtype=bool)).copy()
        for w in np.flatnonzero(hit):
            gone[starts[w] : starts[w + 1]] = True
        runs = np.flatnonzero(np.diff(gone.astype(int), prepend=1, append=1))
        want = "".join(text[a:b].decode(errors="ignore") for a, b in zip(runs[::2], runs[1::2], strict=True))
        assert after[i].text == want
        assert after[i].n_chars == len(after[i].text) and after[i].lang == before[i].lang
        removed += gone.sum()
    assert removed


def test_contamination_stage(spark, staged):
    found = decontamination.decontaminate(staged[3], spark.read.parquet(f"{SF}/benchmark.parquet"))
    clean = {r.doc_id for r in found.filter("n_hit = 0").collect()}
    assert set(rows(staged[4])) == clean and len(clean) < staged[3].count()


def test_packing_stage(staged):
    check_pieces(staged[5].collect(), {i: r.text for i, r in rows(staged[4]).items()})


def test_run(spark, staged):
    result = cp.run(spark, SF)
    assert result.columns == staged[-1].columns and result.count() == staged[-1].count()


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.select("*", F.lit("en").alias("lang"), F.char_length("text").cast("long").alias("n_chars"))
    for name, stage in cp.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert {r.kept for r in kept} == {"mine"}
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert cp.keep_quality(spark, docs, SF).columns == docs.columns
    assert cp.keep_quality(spark, docs.limit(0), SF).collect() == []
    kept = cp.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (1, 2, 3, 4, 5, 6, 7)) == [1, 3, 5]
    assert np.isclose(len(kept), 6)


def test_passages_of_51_words_are_cut(spark):
    rng = np.random.default_rng(5)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), int(rng.integers(1, 8)))) for _ in range(n))
    passage, short, own = make(51), make(50), [make(60) for _ in range(8)]
    assert len(passage) < 400
    texts = [f"{a} {p} {b}" for p, (a, b) in zip((passage, passage, short, short), zip(own[::2], own[1::2], strict=True), strict=True)]
    rows = cp.cut_repeats(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), SF).collect()
    got = [r.text for r in sorted(rows, key=lambda r: r.doc_id)]
    assert got == [f"{own[0]} {own[1]}", f"{own[2]} {own[3]}", *texts[2:]]
