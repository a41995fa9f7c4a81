from __future__ import annotations

from collections import Counter

import pytest

from corpusloom.operators import facets, filters

SCHEMA = "page_id long, l1 string, l2 string, l3 string, cats array<string>"


def corpus(n=600):
    """A third of all rows in one bucket; nulls and empty strings on every level."""
    rows = []
    for i in range(n):
        l1 = "hot" if i % 3 == 0 else [None, "", "a", "b", "c"][i % 5]
        l2 = [None, "x", "y", "z"][i % 4]
        l3 = f"k{i % 7}" if i % 11 else None
        rows.append((i, l1, l2, l3, [f"c{i % 4}", f"c{i % 4}", "all"] if i % 10 else None))
    return rows


def ranked(counter: Counter, n: int):
    return sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:n]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(corpus(), SCHEMA).cache()


def test_terms(df):
    want = ranked(Counter(r[1] for r in corpus() if r[1] is not None), 3)
    assert [tuple(r) for r in facets.terms(df, "l1", 3).collect()] == want
    total = sum(1 for r in corpus() if r[1] is not None)
    assert facets.terms_other_count(df, "l1", 3).first()[0] == total - sum(c for _, c in want)
    assert facets.terms_other_count(df, "l1", 100).first()[0] == 0


def test_terms_multi_counts_a_document_once(df):
    want = ranked(Counter(c for r in corpus() for c in set(r[4] or [])), 10)
    assert [tuple(r) for r in facets.terms_multi(df, "cats", 10).collect()] == want
    hot = ranked(Counter(c for r in corpus() if r[1] == "hot" for c in set(r[4] or [])), 10)
    assert [tuple(r) for r in facets.filtered_terms(df, "l1", "hot", "cats", 10).collect()] == hot


def test_drilldown_cuts_inside_survivors(df):
    rows, want = corpus(), set()
    for k1, n1 in ranked(Counter(r[1] for r in rows if r[1] is not None), 2):
        in1 = [r for r in rows if r[1] == k1]
        for k2, n2 in ranked(Counter(r[2] for r in in1 if r[2] is not None), 2):
            in2 = [r for r in in1 if r[2] == k2]
            for k3, n3 in ranked(Counter(r[3] for r in in2 if r[3] is not None), 2):
                want.add((k1, n1, k2, n2, k3, n3))
    got = facets.drilldown(df, ["l1", "l2", "l3"], [2, 2, 2]).select("l1", "count_1", "l2", "count_2", "l3", "count_3")
    assert {tuple(r) for r in got.collect()} == want


def test_drilldown_keeps_a_bucket_without_children(spark):
    df = spark.createDataFrame([(1, "a", None, None, None), (2, "b", "x", None, None)], SCHEMA)
    got = facets.drilldown(df, ["l1", "l2", "l3"], [5, 5, 5]).select("l1", "count_1", "l2", "count_2", "l3")
    assert {tuple(r) for r in got.collect()} == {("a", 1, None, None, None), ("b", 1, "x", 1, None)}


def test_top_hits(df):
    rows = corpus()
    want = set()
    for key, n in ranked(Counter(r[1] for r in rows if r[1] is not None), 2):
        for hit, r in enumerate(sorted(r[0] for r in rows if r[1] == key)[:3], 1):
            want.add((r, key, n, hit))
    got = facets.top_hits(df, "l1", 2, 3, ["page_id", "l1"])
    assert {tuple(r) for r in got.collect()} == want


def test_top_hits_ranks_before_the_shuffle(df):
    plan = facets.top_hits(df, "l1", 2, 3, ["page_id", "cats"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_breakdown_totals(df):
    rows = facets.breakdown(df, ["l1", "l2", "l3"]).collect()
    by_level = Counter()
    for r in rows:
        by_level[r.level] += r.doc_count
    assert by_level == {0: 600, 1: 600, 3: 600, 7: 600}


def test_filters(df):
    assert filters.term_filter(df, "l1", "hot").count() == 200
    assert filters.term_filter_multi(df, "cats", "all").count() == facets.count_in_category(df, "all", "cats").first()[0] == 540
    assert [r.page_id for r in filters.keyset_page(df, 10, 3).collect()] == [11, 12, 13]
    assert filters.limit_rows(df, 0).count() == 600
    assert [r.page_id for r in filters.limit_rows(df, 2).collect()] == [0, 1]
    assert filters.source_includes(df, ["page_id"]).columns == ["page_id"]
