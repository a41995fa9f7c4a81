from __future__ import annotations

import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import url_filter
from corpusloom.llm.queries import QUERIES, URL_RULES

URLS = [
    "https://WWW.Example.org/es/1?x=/en/", "https://example.org/en/1", "http://a.example.org/en/12#x", "http://org/", "http://example.org",
    "http://notorg/", "https://x.com/fr/1", "https://com/de/", "https://x.com/en/", "no scheme", "", None, "a://b://c/d", "://host?/path",
    "http://host#/p", "http://É.org/ESÉ", "//example.org/es/", "http://user@example.org:80/es/", "line\n://Host.org/p\nq?r",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rest[:end].translate(lower), path[:stop]


def rule_for(host, path):
    found = []
    for verdict, rule in URL_RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            found.append((len(rule), rule, verdict))
    return max(found)[1:] if found else (None, None)


def check(rows):
    for r in rows:
        host, path = parts(r.url)
        rule, verdict = rule_for(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int"))


def test_parts_and_rules(spark, model):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id long, url string, Verdict string")
    rows = url_filter.filter_urls(pages, URL_RULES, model).collect()
    assert len(rows) == 2 * len(URLS) and "Verdict" not in rows[0]
    check(rows)


def test_query_and_method(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = QUERIES["op1_url_filter"](spark, SF).join(pages, "page_id").collect()
    assert len(rows) == pages.count()
    check(rows)
    bad = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
    assert all((r.verdict == "block") == any(b in r.host for b in bad) for r in rows if r.rule is None)


def test_words_that_training_has_not_seen(model):
    score = lambda h: float(model.score([h], ["/en/5"])[0])
    assert score("casinobets.example.com") > 0.5 and score("pornpoker.example.net") > 0.5
    assert score("bookjournal.example.com") < 0.5 and score("") < 0.5


def test_empty(spark, model):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none, URL_RULES, model).collect() == []
    blank = url_filter.train(spark.createDataFrame([], "url string, blocked int"))
    assert url_filter.filter_urls(none, [], blank).collect() == []
