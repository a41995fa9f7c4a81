from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from corpusloom.functions import analysis as an
from corpusloom.operators import segmentation as sg

JAPANESE = "[\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3400-\u9fff々〇]"


def lexicon_of(texts, longest, least):
    runs = Counter(r for t in texts for r in re.findall(f"{JAPANESE}+", t or ""))
    total = sum(len(r) * n for r, n in runs.items())
    counts = Counter()
    for run, n in runs.items():
        for i in range(len(run)):
            for k in range(1, min(longest, len(run) - i) + 1):
                counts[run[i : i + k]] += n
    return {w: math.floor(1000 * math.log(total / n)) for w, n in counts.items() if len(w) == 1 or n >= least}


def viterbi(run, lexicon, longest):
    best = [(0, 0)]
    for end in range(1, len(run) + 1):
        ways = []
        for k in range(1, min(longest, end) + 1):
            word = run[end - k : end]
            cost = lexicon.get(word, max(lexicon.values(), default=-1000) + 1000 if k == 1 else None)
            if cost is not None:
                ways.append((best[end - k][0] + cost, -k))
        cost, k = min(ways)
        best.append((cost, -k))
    words, at = [], len(run)
    while at:
        words.append(run[at - best[at][1] : at])
        at -= best[at][1]
    return words[::-1]


def brute(text, lexicon, longest):
    out = []
    for m in re.finditer(rf"{JAPANESE}+|[^\W_]+?(?={JAPANESE}|\b|_|$)", text or ""):
        at = m.start()
        for word in viterbi(m[0], lexicon, longest) if re.match(JAPANESE, m[0]) else [m[0]]:
            out.append((word, at, at + len(word)))
            at += len(word)
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["東京", "東京都", "知事", "選挙", "の", "は", "日本語", "サーバー", "学", "大学", "を見る", "abc", "x1"]
    return [(i, "".join(rng.choices(words, k=rng.randrange(0, 12))) + rng.choice(["。", " ", "、abc "]) + "".join(rng.choices(words, k=4))) for i in range(120)]


@pytest.mark.parametrize(("longest", "least"), [(4, 3), (2, 1), (1, 1), (3, 10)])
def test_against_brute_force(spark, longest, least):
    docs = [*corpus(longest), (900, ""), (901, None), (902, "abc only"), (902 + 1, "東")]
    lexicon = lexicon_of([t for _, t in docs], longest, least)
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    got = {}
    for r in sorted(sg.segment_corpus(frame, "text", longest=longest, min_count=least).collect(), key=lambda r: (r.doc_id, r.position)):
        got.setdefault(r.doc_id, []).append((r.token, r.start_offset, r.end_offset))
        assert r.position == len(got[r.doc_id]) - 1
    assert got == {i: brute(t, lexicon, longest) for i, t in docs if brute(t, lexicon, longest)}
    if longest == 4:
        assert any(len(w) > 1 for row in got.values() for w, _, _ in row if re.match(JAPANESE, w))


def test_given_lexicon_and_unknown_characters(spark):
    lexicon = spark.createDataFrame([("東京", 10), ("京都", 10), ("東", 50), ("都", 12)], "word string, cost long")
    docs = spark.createDataFrame([(1, "東京都"), (2, "東京都知京都")], "doc_id int, text string")
    got = {}
    for r in sorted(sg.segment_corpus(docs, "text", lexicon=lexicon).collect(), key=lambda r: r.position):
        got.setdefault(r.doc_id, []).append(r.token)
    assert got == {1: ["東京", "都"], 2: ["東京", "都", "知", "京都"]}


def test_very_long_runs(spark):
    """A run of many blocks is cut like any other."""
    run = "".join(random.Random(1).choices(["東京", "知事", "の", "大学院"], k=6000))
    lexicon = lexicon_of([run], 4, 3)
    rows = sorted(sg.segment_corpus(spark.createDataFrame([(1, run)], "doc_id int, text string"), "text").collect(), key=lambda r: r.position)
    assert [r.token for r in rows] == viterbi(run, lexicon, 4)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(corpus(3), "doc_id int, text string")
    plan = sg.segment_corpus(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_filters(spark):
    rows = [(1, w, i, 1, 0, 0, "word") for i, w in enumerate(["ＦＯＸ", "の", "サーバー", "Ab"])]
    table = spark.createDataFrame(rows, "doc_id int, token string, position int, position_length int, start_offset int, end_offset int, type string")
    assert [(r.token, r.position) for r in sg.filter_japanese(table).orderBy("position").collect()] == [("fox", 0), ("サーバ", 2), ("ab", 3)]
    assert "の" in an.JAPANESE_STOP_WORDS


def test_tokens_are_numbered_where_their_document_lies(spark):
    """Documents are placed by key, as lists; neither pieces nor tokens are shuffled for their numbers."""
    docs = spark.createDataFrame(corpus(3), "doc_id int, text string")
    plan = sg.segment_corpus(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and plan.index("Generate posexplode", plan.index("Window")) < plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_short_and_long_runs_are_cut_alike(spark, monkeypatch, longest):
    docs = spark.createDataFrame(corpus(7), "doc_id int, text string")
    rows = lambda: sorted(map(tuple, sg.segment_corpus(docs, "text", longest=longest).collect()))
    short = rows()
    monkeypatch.setattr(sg, "SHORT", 0)
    assert rows() == short and short


def test_rare_runs_are_numbered_like_frequent_ones(spark, monkeypatch):
    docs = spark.createDataFrame([*corpus(8), (None, "東京 は"), (None, "の ガ")], "doc_id int, text string")
    rows = lambda: sorted(map(str, sg.segment_corpus(docs, "text").collect()))
    every = rows()
    for frequent in (1, 7):
        monkeypatch.setattr(sg, "FREQUENT", frequent)
        assert rows() == every


def test_documents_of_one_key_interleave(spark):
    docs = spark.createDataFrame([(1, "東 abc。"), (1, "東 abc。"), (2, " 。 "), (3, " x ")], "doc_id int, text string")
    got = sorted((r.doc_id, r.position, r.token, r.start_offset) for r in sg.segment_corpus(docs, "text").collect())
    assert got == [(1, 0, "東", 0), (1, 1, "東", 1), (1, 2, "abc", 4), (1, 3, "abc", 7), (3, 0, "x", 1)]
    pieces = sorted((r.doc_id, r.run, r.piece, r.start_offset) for r in sg.pieces(docs.filter("doc_id = 3"), "text").collect())
    assert pieces == [(3, 1, "x", 1)]


def test_pieces_move_as_one_text(spark):
    """A document's pieces used to move as rows of a list, each word of a rare run with its end and its length."""
    docs = spark.createDataFrame([*corpus(9), (900, ""), (901, None), (902, "。 、")], "doc_id int, text string")
    found = sg.segment_corpus(docs, "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan[plan.index("Exchange hashpartitioning") :].splitlines()[1:] if "listed" in line or "pieces" in line)
    assert "listed" in exchange
    lexicon = lexicon_of([t for _, t in docs.collect() if t], 4, 3)
    got = sorted((r.doc_id, r.position, r.token, r.start_offset, r.end_offset) for r in found.collect())
    assert got == sorted((i, n, *w) for i, t in docs.collect() for n, w in enumerate(brute(t, lexicon, 4)))


def test_runs_that_occur_equally_often_are_frequent_together(spark, monkeypatch):
    """No table is cut: of runs with one count either all are held by every task or none."""
    docs = spark.createDataFrame(corpus(4), "doc_id int, text string")
    rows = lambda: sorted(map(str, sg.segment_corpus(docs, "text").collect()))
    every = rows()
    monkeypatch.setattr(sg, "FREQUENT", 0)
    assert rows() == every
