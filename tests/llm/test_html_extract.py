from __future__ import annotations

import html
import re

import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import html_extract
from corpusloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.train(spark.createDataFrame(html_extract.labelled_pages(), "html string, main array<string>"))


def article(page):
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    blocks = (re.sub(r"<[^>]*>?", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)\b[^>]*>?", inside))
    return "\n\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op4_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_unseen_pages(model):
    wrong = total = 0
    for page, main in html_extract.labelled_pages(120, seed=1234):
        blocks = html_extract.leaf_blocks(page)
        gold = [int(b.text in set(main)) for b in blocks]
        wrong += sum(a != b for a, b in zip(model.label(blocks, {}), gold, strict=True))
        total += len(blocks)
    assert wrong / total < 0.01


def test_viterbi_finds_the_best_labels(model):
    from itertools import product

    for page, _ in html_extract.labelled_pages(12, seed=77):
        blocks = html_extract.leaf_blocks(page)[:9]
        own = [
            model._sum(html_extract.ancestor_features(b.stack)) + model._sum(html_extract.text_features(b)) for b in blocks
        ]

        def score(labels, own=own):
            total = model.edges[0][labels[0]] + model.edges[1][labels[-1]]
            total += sum(o[k] + o[2 + k] for o, k in zip(own, labels, strict=True))
            return total + sum(model.moves[a][b] for a, b in zip(labels, labels[1:], strict=False))

        best = max(map(score, product((0, 1), repeat=len(blocks))))
        assert abs(score(model.label(blocks, {})) - best) < 1e-9


def test_parts_of_pages(model):
    page = (
        '<body><nav><a href="/">Home</a></nav><aside class="sidebar"><p>Read also this.</p></aside><div class="cookie-notice">We use cookies here.</div>'
        "<article><h1>A &lt;title&gt; &amp; more</h1><p>First\n\t<i>par</i>agraph &eacute;&#233;&#xe9; text.<p>Second<br>one<script>var x='<p>no</p>'</script>"
        '<!-- <p>no</p> --><form><label>Your name</label></form></article><section id="comments"><div class="comment"><p>Nice read.</p></div></section>'
        "<footer>&copy; someone</footer><p"
    )
    assert html_extract.main_text(page, model, {}) == "A <title> & more\n\nFirst paragraph ééé text.\n\nSecond one"
    for empty in (None, "", "   ", "<p>", "<!-- x", "<script>a", "<<<>>><", "</p></div>"):
        assert isinstance(html_extract.main_text(empty, model, {}), str)


def test_edges(spark, model):
    rows = [(1, None), (1, None), (None, ""), (2, "<article>" + "<p>Some long text here.</p>" * 20_000), (3, "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'u' as url", "'mine' as TEXT", "'k' as other")
    got = html_extract.extract(pages, model).collect()
    assert len(got) == 5 and {r.other for r in got} == {"k"}
    assert {r.n_chars for r in got if r.page_id in (1, None)} == {0}
    assert next(r.n_chars for r in got if r.page_id == 2) == 20_000 * 21 + 19_999 * 2 - 20_000 * 21 + 20_000 * 20
    assert html_extract.extract(pages.limit(0), model).collect() == []
    assert html_extract.train(spark.createDataFrame([], "html string, main array<string>")).label(html_extract.leaf_blocks("<p>a</p>"), {}) == [0]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p class=a">Hello one</p><p class=b">Hello two</p><p>three</p>', ["Hello one", "Hello two", "three"]),
        ("<td width=5'>Main one</td><td width=6'>Main two</td>", ["Main one", "Main two"]),
        ("<p title=\"a > b\" class='x>y'>one</p><p a= \"q>\" b =c d>two</p>", ["one", "two"]),
        ("<p title=it's>one</p><p data-x=5\">two's</p><p =>three</p>", ["one", "two's", "three"]),
        ('<script src="a>b">no</script><script data=x">no</script><p/ id=m/>yes</p>', ["yes"]),
        ('<p class="open>one</p><p>two</p>', ["one", "two"]),
    ],
)
def test_quotes_open_strings_only_after_equals_signs(page, want):
    assert [b.text for b in html_extract.leaf_blocks(page)] == want


def test_long_broken_tags_take_no_long_time():
    for page in ('<p ' + 'a="' * 60_000, "<p" + " a=b" * 60_000, "<" * 60_000, "<a " * 30_000, "<p " + "='" * 60_000):
        html_extract.leaf_blocks(page)
