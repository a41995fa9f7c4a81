from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import analysis as an
from corpusloom.operators import search, tokens


@pytest.mark.parametrize(
    "analyzer, source, want",
    [
        (an.tok_whitespace, " The  2 Foxes'\tran　x", ["The", "2", "Foxes'", "ran", "x"]),
        (an.tok_simple, "The 2 Foxes' run", ["the", "foxes", "run"]),
        (an.tok_simple, "İΣΑΣ", ["iσασ"]),
        (an.tok_stop, "The fox and the hound", ["fox", "hound"]),
        (an.tok_keyword, "New York", ["New York"]),
        (an.tok_keyword, "", []),
        (an.tok_pattern, "The_2 foxes-ran é", ["the_2", "foxes", "ran"]),
        (an.tok_standard, "Fox２ 東京タワーのMap", ["fox２", "東", "京", "タワー", "の", "map"]),
        (an.tok_cjk_bigram, "東京都知事選挙", ["東京", "京都", "都知", "知事", "事選", "選挙"]),
        (an.tok_cjk_bigram, "国 is 日本!Fox", ["国", "is", "日本", "Fox"]),
        (an.tok_cjk_bigram, "", []),
        (an.tok_cjk_bigram, "𠮷野家x", ["𠮷野", "野家", "x"]),
        (an.width_fold, "ＡＢｶﾞﾊﾟｱﾞｳﾞ", "ABガパア゙ヴ"),
        (an.width_fold, "カﾞ abc", "ガ abc"),
        (an.width_fold, "ｦﾝ･ｰ", "ヲン・ー"),
        (lambda c: an.katakana_stem(F.split(c, " ")), "コピー サーバー サーバーー ー x", ["コピー", "サーバ", "サーバー", "ー", "x"]),
        (lambda c: an.ja_stopwords(F.split(c, " ")), "これ 東京 の こと の 都", ["東京", "都"]),
        (lambda c: an.lowercase_tokens(F.split(c, " ")), "AbC Ｄ", ["abc", "ｄ"]),
        (lambda c: an.drop_punctuation(F.split(c, " ")), "a 。 -- 1 々", ["a", "1", "々"]),
        (an.analyze_japanese, "東京 ＦＯＸ、のこ", ["東京", "fox", "のこ"]),
        (an.analyze_japanese, "、。", []),
    ],
)
def test_analyzers(texts, analyzer, source, want):
    assert texts(analyzer, source) == want


DOCS = [(1, "a bb  a\nccc"), (2, ""), (3, "  x "), (4, "𠮷 b b b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").cache()


def test_token_table(docs):
    rows = tokens.token_table(docs, "text").collect()
    texts = dict(DOCS)
    assert all(texts[r.doc_id][r.start_offset : r.end_offset] == r.token for r in rows)
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.position)):
        got.setdefault(r.doc_id, []).append((r.position, r.token, r.position_length, r.type))
    want = {i: [(p, w, 1, "word") for p, w in enumerate(t.split())] for i, t in DOCS if t.split()}
    assert got == want


@pytest.mark.parametrize("analyzer", sorted(an.RUNS))
def test_token_tables_agree_with_the_analyzers(spark, analyzer):
    sources = [(1, "The Fox, and THE hound_2 ran"), (2, ""), (3, None), (4, "東京タワーのMap İΣΑΣ x"), (5, "... a"), (6, "to be\nor")]
    df = spark.createDataFrame(sources, "doc_id long, text string")
    got = {}
    for r in sorted(tokens.token_table(df, "text", analyzer=analyzer).collect(), key=lambda r: (r.doc_id, r.position)):
        got.setdefault(r.doc_id, []).append(r)
        assert an.ENGLISH_STOP_WORDS and len(r.token) == r.end_offset - r.start_offset
        assert dict(sources)[r.doc_id][r.start_offset : r.end_offset].lower().startswith(r.token[:1].lower())
    want = {r.doc_id: r.t for r in df.select("doc_id", an.ANALYZERS[analyzer](F.col("text")).alias("t")).collect() if r.t}
    assert {i: [r.token for r in rows] for i, rows in got.items()} == want
    if analyzer == "stop":
        assert [(r.token, r.position) for r in got[1]] == [("fox", 1), ("hound", 4), ("ran", 5)]


def test_token_steps_move_the_text_once(docs):
    plan = tokens.token_graph_edges(tokens.token_table(docs, "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_token_graph(spark):
    table = spark.createDataFrame(
        [
            (1, "東京都", 0, 2, 0, 3),
            (1, "東京", 0, 1, 0, 2),
            (1, "トーキョー", 0, 1, 0, 2),
            (1, "都", 1, None, 2, 3),
            (1, "知事", 5, 0, 3, 5),
        ],
        "doc_id long, token string, position int, position_length int, start_offset int, end_offset int",
    )
    nodes = {r["node"]: r["index"] for r in tokens.token_graph_nodes(table).collect()}
    assert nodes == {0: 0, 1: 1, 2: 2, 5: 3, 6: 4}
    edges = {r.token: (r.src, r.dst, r.span, r.is_multi, r.parallel) for r in tokens.token_graph_edges(table).collect()}
    assert edges["東京都"] == (0, 2, 2, True, 0)
    assert {edges["東京"][4], edges["トーキョー"][4]} == {0, 1}
    assert edges["都"] == (1, 2, 1, False, 0) and edges["知事"] == (5, 6, 1, False, 0)


def test_postings(docs):
    got = {(r.term, r.doc_id): (r.tf, r.doc_len) for r in tokens.build_postings(docs, "text", "whitespace").collect()}
    want = {(w, i): (n, len(t.split())) for i, t in DOCS for w, n in Counter(t.split()).items()}
    assert got == want


@pytest.mark.parametrize("rare_share", [0.0, 0.2, 1.0])
def test_bm25_against_the_formula(spark, monkeypatch, rare_share):
    monkeypatch.setattr(search.bm25_topk, "__defaults__", (*search.bm25_topk.__defaults__[:-1], rare_share))
    corpus = {i: " ".join(["the"] * (i % 4 + 1) + [f"w{i % 7}", f"v{i % 3}"] * (i % 3)) for i in range(60)}
    queries = {1: "the w3 w3", 2: "v1 absent", 3: "absent"}
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    asked = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    got = {}
    for r in search.search(docs, asked, 5, analyzer="whitespace").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))

    split = {i: t.split() for i, t in corpus.items()}
    n, mean = len(split), sum(map(len, split.values())) / len(split)
    want = {}
    for q, text in queries.items():
        scores = {}
        for i, words in split.items():
            total = 0.0
            for w in text.split():
                tf, df = words.count(w), sum(w in ws for ws in split.values())
                if tf:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
            if total:
                scores[i] = round(total, 6)
        if scores:
            want[q] = sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-6)


def test_metadata_search(spark):
    records = spark.createDataFrame(
        [("w", "r1", "Fox hunt", ["red", "big"]), ("w", "r2", "hound", ["fox"]), ("w", "r3", "cat", []), ("v", "r1", "fox", [])],
        "workspace_id string, record_id string, name string, tags array<string>",
    )
    asked = spark.createDataFrame([("w", 1, "FOX big")], "workspace_id string, query_id int, text string")
    rows = search.metadata_search(records, asked, ["name", "tags"], 10).orderBy("rank").collect()
    assert [r.record_id for r in rows] == ["r1", "r2"]


def test_offsets_are_counted_without_sorting_tokens(docs):
    """Token rows used to be sorted by two windows, which spilled the whole table to disk."""
    plan = tokens.token_table(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan


@pytest.mark.parametrize("share", [1, 7, 1 << 22])
@pytest.mark.parametrize("analyzer", sorted(an.RUNS))
def test_offsets_of_odd_texts(spark, monkeypatch, analyzer, share):
    """Texts that hold the mark or what stands for it, wide characters, connectors, keys that repeat."""
    monkeypatch.setattr(tokens, "SHARE", share)
    odd = ["a\x00b cc", "𠮷\x00 ﷐x é", "__ _a _́_あ__b 3.14 it's", "カ_カ 東京a", "\x00", " ", "é" * 300 + " to x", tokens.SPARE + " y"]
    df = spark.createDataFrame([*enumerate(odd), (100, "b c"), (100, None), (100, "b c")], "doc_id long, text string")
    rows = tokens.token_table(df, "text", analyzer=analyzer).collect()
    for i, t in enumerate(odd):
        got = sorted((r.position, r.start_offset, r.end_offset, r.token) for r in rows if r.doc_id == i)
        assert all(r[3] == an_folded(t, analyzer)[r[1] : r[2]] for r in got)
        want = df.filter(F.col("doc_id") == i).select(an.ANALYZERS[analyzer](F.col("text")).alias("t")).first().t
        assert [r[3] for r in got] == want
    twice = sorted((r.position, r.start_offset, r.end_offset, r.token) for r in rows if r.doc_id == 100)
    once = [("b c",)] if analyzer == "keyword" else [("b",), ("c",)]
    assert [r[3] for r in twice] == [w for (w,) in once for _ in range(2)]
    assert [r[1:3] for r in twice] == ([(0, 3), (3, 6)] if analyzer == "keyword" else [(0, 1), (1, 2), (4, 5), (5, 6)])


def an_folded(text, analyzer):
    return text if analyzer in ("whitespace", "keyword") else text.lower()


def test_long_texts_of_one_key(spark):
    """Texts of one key are cut once, not once per run."""
    words = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(1, " ".join(words))] * 2, "doc_id long, text string")
    rows = sorted((r.position, r.token, r.end_offset) for r in tokens.token_table(df, "text").collect())
    assert [t for _, t, _ in rows] == [w for w in words for _ in range(2)] and rows[-1][2] == 2 * len(" ".join(words))


@pytest.mark.parametrize("analyzer", sorted(an.RUNS))
def test_packed_lists_hold_the_same_words(spark, analyzer):
    """The words of a list move as one text: odd ones, dropped words, none at all."""
    odd = ["a\x00b the cc", "𠮷\x00 ﷐x é", "", None, "...", "to be", "\x00", tokens.SPARE + " y"]
    df = spark.createDataFrame([*enumerate(odd), (100, "b c"), (100, None), (100, "the b c"), (None, "x y")], "doc_id long, text string")
    lists, late = (tokens.token_lists(df, "text", analyzer=analyzer, late=late) for late in (False, True))
    assert sorted(map(str, tokens.token_rows(late).collect())) == sorted(map(str, tokens.token_rows(lists).collect()))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Exchange")
    words = F.posexplode(tokens.unpacked_words(F.col("_list"))).alias("position", "token")
    packed = tokens.packed_lists(lists).select("doc_id", words, "_list.starts").filter("token <> ''")
    got = sorted(str(tuple(r)) for r in packed.selectExpr("doc_id", "position", "token", "get(starts, position)").collect())
    assert got == sorted(str(tuple(r)) for r in tokens.token_rows(lists).select("doc_id", "position", "token", "start_offset").collect()) and got
