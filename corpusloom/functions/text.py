"""Wikitext cleaning, category extraction and URLs as Column expressions.

Everything stays inside the JVM except :func:`html_unescape`, the one Arrow boundary.
Java, not Python, runs these patterns, so Unicode space and line ends are spelled out.
"""

from __future__ import annotations

import html
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of an Arrow batch that are Python strings at a time.
FEW = 64

# Patterns, prefixes and sizes that decide the result.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_SPACE_OR_BRACKET = r"[^\s\x1c-\x1f\x85\p{Z}\]]"
COMMENT = r"(?s)<!--.*?-->"
PAIRED_REF = r"(?s)<ref[^>]*>.*?</ref>"
SELF_CLOSING_REF = r"<ref[^/]*/>"
TAG = r"<[^>]+>"
INNERMOST_TEMPLATE = r"\{\{[^{}]*\}\}"
MEDIA_OR_CATEGORY_LINK = r"\[\[(?:File|ファイル|Image|Category|カテゴリ):[^\]]+\]\]"
EXTERNAL_LINK = rf"\[https?://{NOT_SPACE_OR_BRACKET}+{SPACE}*([^\]]*)\]"
PIPED_LINK = r"\[\[([^\]|]+)\|([^\]]+)\]\]"
PLAIN_LINK = r"\[\[([^\]]+)\]\]"
HEADING = rf"(?dm)^=+{SPACE}*(.*?){SPACE}*=+$"
CATEGORY_LINK = r"\[\[(?:Category|カテゴリ):([^\]|]+)(?:\|[^\]]*)?\]\]"
TEMPLATE_PASSES = 3
BODY_CHARS = 5000
WIKI_URL_BASE = "https://ja.wikipedia.org/wiki/"


def strip_comments(c: Column) -> Column:
    """HTML comments, over line ends, become a space."""
    return F.regexp_replace(c, COMMENT, " ")


def strip_paired_refs(c: Column) -> Column:
    """``<ref>…</ref>`` becomes a space; a self-closing ref also opens the match."""
    return F.regexp_replace(c, PAIRED_REF, " ")


def strip_selfclosing_refs(c: Column) -> Column:
    """``<ref … />`` becomes a space."""
    return F.regexp_replace(c, SELF_CLOSING_REF, " ")


def strip_tags(c: Column) -> Column:
    """Any remaining tag becomes a space."""
    return F.regexp_replace(c, TAG, " ")


def strip_template_pass(c: Column) -> Column:
    """Innermost templates become a space, once."""
    return F.regexp_replace(c, INNERMOST_TEMPLATE, " ")


def strip_templates(c: Column) -> Column:
    """Innermost templates become a space, three times; deeper nesting leaves a remainder."""
    return reduce(lambda text, _: strip_template_pass(text), range(TEMPLATE_PASSES), c)


def strip_media_category_links(c: Column) -> Column:
    """File, image and category links become a space."""
    return F.regexp_replace(c, MEDIA_OR_CATEGORY_LINK, " ")


def unwrap_external_links(c: Column) -> Column:
    """``[http://… label]`` keeps its label."""
    return F.regexp_replace(c, EXTERNAL_LINK, " $1 ")


def unwrap_piped_links(c: Column) -> Column:
    """``[[target|label]]`` keeps its label."""
    return F.regexp_replace(c, PIPED_LINK, " $2 ")


def unwrap_links(c: Column) -> Column:
    """``[[target]]`` keeps its target."""
    return F.regexp_replace(c, PLAIN_LINK, " $1 ")


def unwrap_headings(c: Column) -> Column:
    """``== heading ==`` on a line of its own keeps the heading; only ``\\n`` ends a line."""
    return F.regexp_replace(c, HEADING, " $1 ")


def strip_emphasis(c: Column) -> Column:
    """Bold, then italic quote marks become a space."""
    return F.replace(F.replace(c, F.lit("'''"), F.lit(" ")), F.lit("''"), F.lit(" "))


def html_unescape(c: Column) -> Column:
    """Replace HTML entities; only texts that hold ``&`` travel to Python.

    The function is local, so that it travels by value and workers need no copy of this
    package. It is declared non-deterministic so that a filter on the result is not pushed
    below it, which would run the Python stage twice. Of an Arrow batch only a few texts at a
    time become Python strings, which take several times the memory.
    """
    few = FEW

    def unescape(texts: pa.Array) -> pa.Array:
        parts = [
            pa.array([None if t is None else html.unescape(t) for t in texts.slice(at, few).to_pylist()], pa.string())
            for at in range(0, len(texts), few)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    udf = F.arrow_udf(unescape, T.StringType()).asNondeterministic()
    return F.coalesce(udf(F.when(F.contains(c, F.lit("&")), c)), c)


def collapse_ws(c: Column) -> Column:
    """Runs of Unicode white space become one space; both ends are trimmed.

    A single plain space, by far the most frequent run, is already right and is not matched.
    """
    return F.trim(F.regexp_replace(c, rf"{SPACE}{{2,}}|[{SPACE}&&[^ ]]", " "))


#: Markup steps before entities are replaced, in the order that is part of the contract, and a
#: piece of text without which a step changes nothing.
MARKUP_STEPS = (
    (strip_comments, "<!--"),
    (strip_paired_refs, "</ref>"),
    (strip_selfclosing_refs, "/>"),
    (strip_tags, "<"),
    *[(strip_template_pass, "}}")] * TEMPLATE_PASSES,
    (strip_media_category_links, "[["),
    (unwrap_external_links, "[http"),
    (unwrap_piped_links, "[["),
    (unwrap_links, "[["),
    (unwrap_headings, "="),
    (strip_emphasis, "''"),
)


def strip_wikitext(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the plain text of the wikitext column ``text``.

    A frame transform rather than a Column: each step is projected once and then referenced.
    So a step's pattern runs only on texts that hold its mark, for which a plain search is
    enough, and the entity step, which reads its input twice, does not repeat the others.
    """
    work = "_stripped"
    df = df.withColumn(work, F.col(text))
    for step, mark in MARKUP_STEPS:
        df = df.withColumn(work, F.when(F.contains(work, F.lit(mark)), step(F.col(work))).otherwise(F.col(work)))
    return df.withColumn(out, collapse_ws(html_unescape(F.col(work)))).drop(work)


def truncate_body(c: Column, chars: int = BODY_CHARS) -> Column:
    """The first ``chars`` code points."""
    return F.substring(c, 1, chars)


def wiki_url(title: Column, base: str = WIKI_URL_BASE) -> Column:
    """Page address: spaces as ``_``, the rest percent-encoded, ``/`` kept."""
    encoded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for coded, plain in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(coded), F.lit(plain))
    return F.concat(F.lit(base), encoded)


def normalize_category(c: Column) -> Column:
    """Underscores as spaces, white space collapsed."""
    return collapse_ws(F.replace(c, F.lit("_"), F.lit(" ")))


def category_from_title(title: Column) -> Column:
    """What follows the first ``:`` of a category page title, or the whole title."""
    after = F.substr(title, F.instr(title, ":") + F.lit(1))
    return normalize_category(F.when(F.contains(title, F.lit(":")), after).otherwise(title))


def dedupe_keep_order(values: Column) -> Column:
    """Distinct values in first-seen order."""
    return F.array_distinct(values)


def extract_categories(text: Column) -> Column:
    """Normalized, non-empty names of all category links in first-seen order."""
    names = F.transform(F.regexp_extract_all(text, F.lit(CATEGORY_LINK), F.lit(1)), normalize_category)
    return dedupe_keep_order(F.filter(names, lambda name: name != ""))
