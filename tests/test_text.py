from __future__ import annotations

import html
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as tx


def clean(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = [r.out for r in tx.strip_wikitext(df, "v", "out").orderBy("i").collect()]
    return out[0] if len(values) == 1 else out


@pytest.mark.parametrize(
    "step, source, expected",
    [
        (tx.strip_comments, "a<!-- x\ny -->b", "a b"),
        (tx.strip_comments, "a<!-- open", "a<!-- open"),
        (tx.strip_paired_refs, "a<ref>x\ny</ref>b", "a b"),
        (tx.strip_paired_refs, '<ref name="a"/> keep? <ref>x</ref>z', " z"),
        (tx.strip_selfclosing_refs, 'a<ref name="n" />b', "a b"),
        (tx.strip_selfclosing_refs, 'a<ref name="x/y" />b', 'a<ref name="x/y" />b'),
        (tx.strip_tags, "a<br>b</p>c<>", "a b c<>"),
        (tx.strip_templates, "{{a}}x", " x"),
        (tx.strip_templates, "{{a{{b{{c}}}}}}x", " x"),
        (tx.strip_templates, "{{a{{b{{c{{d}}}}}}}}x", "{{a }}x"),
        (tx.strip_media_category_links, "[[File:a.png|b]][[画像:c]][[カテゴリ:d]]", " [[画像:c]] "),
        (tx.unwrap_external_links, "[http://a.b c d] [https://e]", " c d    "),
        (tx.unwrap_external_links, "[http://a.b　c]", " c "),
        (tx.unwrap_piped_links, "[[a|b]][[c]]", " b [[c]]"),
        (tx.unwrap_links, "[[a]]", " a "),
        (tx.unwrap_headings, "== h ==\nx", " h \nx"),
        (tx.unwrap_headings, "== h ==\r\nx", "== h ==\r\nx"),
        (tx.unwrap_headings, "x == h ==", "x == h =="),
        (tx.strip_emphasis, "'''a''' ''b''", " a   b "),
        (tx.collapse_ws, " a　 b c\x1cd\x85e \n", "a b c d e"),
        (tx.collapse_ws, "a  b c\td", "a b c d"),
        (tx.normalize_category, "_a__b　c ", "a b c"),
        (tx.category_from_title, "Category:a:b_c", "a:b c"),
        (tx.category_from_title, "no colon_", "no colon"),
    ],
)
def test_steps(texts, step, source, expected):
    assert texts(step, source) == expected


def test_truncate_counts_code_points(texts):
    assert texts(lambda c: tx.truncate_body(c, 2), "𠮷野家") == "𠮷野"


def test_wiki_url(texts):
    assert texts(lambda c: tx.wiki_url(c, ""), "A/B~c*d+e (f)!'") == "A/B~c%2Ad%2Be_%28f%29%21%27"
    assert texts(tx.wiki_url, "東京 都") == "https://ja.wikipedia.org/wiki/%E6%9D%B1%E4%BA%AC_%E9%83%BD"


def test_extract_categories(texts):
    found = texts(tx.extract_categories, "[[Category:b_c|k]] [[カテゴリ:a]][[Category:b c]] [[category:n]] [[Category: ]]")
    assert found == ["b c", "a"]


def test_entities_survive_as_text(spark):
    assert clean(spark, "&lt;b&gt; x&nbsp;y &amp;amp;") == "<b> x y &amp;"


def test_whole_article(spark):
    source = (
        "<!-- c\n -->\n== 概要 ==\n{{Infobox|{{in|x}}}}'''東京'''は[[日本|日本国]]の[[首都]]<ref name=\"a\">r</ref>。"
        "[[File:a.png|thumb]] [http://x.example/ 公式] [[Category:東京|*]]"
    )
    assert clean(spark, source) == "概要 東京 は 日本国 の 首都 。 公式"


def test_empty_and_plain(spark):
    assert clean(spark, "", "   ", "plain text") == ["", "", "plain text"]


text = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text, min_size=2, max_size=30))
def test_standard_library_agrees(texts, values):
    values += ["x &amp; y", "&copy", "&#x41;&#66;", "&notit;"]
    assert texts(tx.collapse_ws, *values) == [" ".join(v.split()) for v in values]
    assert texts(tx.html_unescape, *values) == [html.unescape(v) for v in values]
    assert texts(lambda c: tx.wiki_url(c, ""), *values) == [urllib.parse.quote(v.replace(" ", "_")) for v in values]
    assert texts(tx.category_from_title, *values) == [
        " ".join((v.split(":", 1)[1] if ":" in v else v).replace("_", " ").split()) for v in values
    ]


def test_cleaning_is_idempotent_on_plain_text(spark):
    once = clean(spark, "a  b [[c|d]] {{e}}", "x\n\ny")
    assert clean(spark, *once) == once


def test_all_entities(texts):
    from html.entities import html5

    names = [f"&{n}" for n in html5] + [f"a&{n}b &{n};" for n in html5 if not n.endswith(";")]
    numbers = [*range(0, 0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000]
    values = names + [f"&#{n};x" for n in numbers] + [f"&#X{n:x}&#x{n:X};" for n in numbers]
    values += ["&notit;", "&notin", "&ampamp;", "&amp;lt;", "&", "&&", "& x", "&;", "&#", "&#;", "&#x;", "&#xg;", "&#99999999999999999999;"]
    values += ["&#x00000000041;", "&#0000000000065", "&" + "a" * 40 + ";", "&é;", "&am", "&LT", "&\n", "&lt\t&gt<&quot&apos;", "", "no entity"]
    assert texts(tx.html_unescape, *values) == [html.unescape(v) for v in values]


def test_one_python_stage_although_filtered(spark):
    from corpusloom.operators.filters import filter_articles

    pages = spark.createDataFrame([(1, "t", 0, False, "x &amp; y")], "page_id long, title string, ns int, redirect boolean, text string")
    plan = filter_articles(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert filter_articles(pages).select(F.col("body")).first().body == "x & y"


def test_entities_are_replaced_a_few_texts_at_a_time(spark, monkeypatch):
    """A whole batch of texts used to become Python strings at once."""
    from corpusloom.functions import text as tx

    seen = []
    monkeypatch.setattr(tx.F, "arrow_udf", lambda function, kind: seen.append(function) or real(function, kind))
    texts = [None if i % 7 == 0 else f"{i} &amp; &lt;é" for i in range(3 * tx.FEW + 5)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", tx.html_unescape(F.col("t")).alias("u")).collect()}
    assert seen and got == {i: t if t is None else f"{i} & <é" for i, t in enumerate(texts)}


real = F.arrow_udf
