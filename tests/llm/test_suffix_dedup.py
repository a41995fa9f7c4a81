from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import suffix_dedup
from corpusloom.llm.queries import QUERIES
from corpusloom.session import matching_paths, scratch_dir

N = suffix_dedup.LENGTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + N] for d in data for i in range(len(d) - N + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - N + 1):
            if seen[d[i : i + N]] > 1:
                gone[i : i + N] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    rows = sorted(df.collect(), key=lambda r: r.doc_id)
    return [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé"), int(rng.integers(1, 9)))) for _ in range(n))


def samples():
    rng = np.random.default_rng(4)
    passage, other = words(rng, 120), words(rng, 90)
    texts = [words(rng, 200) for _ in range(4)]
    texts += [words(rng, 60) + passage + words(rng, 60) for _ in range(6)]
    texts += [words(rng, 30) + passage[: int(rng.integers(350, 600))] + words(rng, 30) for _ in range(12)]
    texts += [other + words(rng, 5) + other, other, other[:399], other[:400], passage, passage, "ab" * 900, "ab" * 450 + "c", "z" * 399, "z" * 400]
    texts += [None, "", "short", "short", texts[0][:300] + words(rng, 3) + texts[0][300:]]
    return texts


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 3}, {"hot_rows": 2}])
def test_against_brute_force(docs, limits):
    texts = samples()
    assert result(suffix_dedup.remove_repeats(docs(*texts), **limits)) == brute(texts)


def test_segments(monkeypatch, docs):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 256)
    texts = samples()
    for text in texts:
        data = np.frombuffer((text or "").encode(), dtype=np.uint8)
        small = suffix_dedup.find_anchors(data)
        monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 20)
        for a, b in zip(small, suffix_dedup.find_anchors(data), strict=True):
            assert (a == b).all()
        monkeypatch.setattr(suffix_dedup, "SEGMENT", 256)


def test_multikey_quicksort():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    got = rows[suffix_dedup.multikey_quicksort(rows)]
    assert [tuple(r) for r in got] == sorted(tuple(r) for r in rows)


def test_query(spark):
    rows = sorted(QUERIES["op6_suffix_dedup"](spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute([t for _, t in docs])
    assert [tuple(r)[1:5] for r in rows] == want
    assert all(len(r.kept_text.encode()) <= size - gone for r, (size, gone, _, _) in zip(rows, want, strict=True))


def test_edges(edge_docs, no_docs):
    rows = suffix_dedup.remove_repeats(edge_docs).collect()
    assert len(rows) == edge_docs.count() and {r.Score for r in rows} == {"mine"}
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert bytes(by_id[5].kept) == b"" and by_id[5].n_spans == 1 and bytes(by_id[9].kept) == b""
    assert by_id[3].n_bytes == 0 and by_id[8].kept_text == by_id[8].text
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def test_cut_characters_leave_the_text(docs):
    rng = np.random.default_rng(9)
    shared = words(rng, 120)
    a, b = "é" + shared + "é" + words(rng, 9), "ã" + shared + "ã" + words(rng, 9)  # second bytes differ, first are equal
    rows = suffix_dedup.remove_repeats(docs(a, b)).collect()
    assert all("�" not in r.kept_text and r.kept_text == bytes(r.kept).decode(errors="ignore") for r in rows)


def brute_words(texts, n):
    data = [(t or "").split() for t in texts]
    seen = Counter(tuple(d[i : i + n]) for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - n + 1):
            if seen[tuple(d[i : i + n])] > 1:
                gone[i : i + n] = True
        out.append([w for w, g in zip(d, gone, strict=True) if not g])
    return out


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 3}, {"hot_rows": 2}])
def test_passages_of_51_words(docs, limits):
    rng = np.random.default_rng(12)
    make = lambda n: " ".join("".join(rng.choice(list("abcdeé"), int(rng.integers(1, 6)))) for _ in range(n))
    exact, short, long, tiny = make(51), make(50), make(140), " ".join(rng.choice(list("abcdefghij"), 51))
    texts = [f"{make(int(rng.integers(0, 90)))} {p} {make(int(rng.integers(0, 90)))}" for p in (exact, short, long, tiny) for _ in range(3)]
    texts += [" ".join(long.split()[i : i + 51]) + "\n" + make(8) for i in (0, 30, 89)]
    texts += [exact, exact, short, short, exact.replace(" ", "\n"), make(9) + " " + exact + " " + exact, "", None, *[make(200)] * 2]
    rows = sorted(suffix_dedup.remove_repeats(docs(*texts), words=51, **limits).collect())
    assert [r.kept_text.split() for r in rows] == brute_words(texts, 51)


def test_strings_of_few_words_still_go(docs):
    rng = np.random.default_rng(13)
    blob = "".join(rng.choice(list("abcdef"), 900))
    a, b = "q" + blob[:500] + "r one", "s two" + blob[100:]
    rows = sorted(suffix_dedup.remove_repeats(docs(a, b, blob[:399], blob[200:600], blob[200:600]), words=51).collect())
    assert [r.kept_text for r in rows] == [r.kept_text for r in sorted(suffix_dedup.remove_repeats(docs(a, b, blob[:399], blob[200:600], blob[200:600])).collect())]
    assert rows[0].n_removed > 0 and rows[3].n_removed == 400


def test_only_ranges_stay_stored(spark):
    """The tables that the ranges are made from are gone before the texts are cut."""
    before = set(matching_paths(spark, f"{scratch_dir(spark)}/*"))
    rows = spark.createDataFrame([(i, "word " * 200 + str(i % 3)) for i in range(9)], "doc_id int, text string")
    spans = suffix_dedup.repeated_spans(rows)
    left = [p.rsplit("/", 1)[1] for p in set(matching_paths(spark, f"{scratch_dir(spark)}/*")) - before]
    assert len(left) == 1 and left[0].startswith("spans-") and spans.count() == 3
