"""The registered queries once more as SQL for an independent engine.

Written from the rules, not from the Spark plans: order-keeping dedupe is ``min(position)``,
character classes are spelled out, hierarchies are plain joins.
"""

from __future__ import annotations

from corpusloom.functions import analysis as an
from corpusloom.functions import wordbreak as wb
from corpusloom.operators import collocations, comparison, segmentation
from corpusloom.operators.search import B, K1
from corpusloom.plans.fixtures import with_fixtures
from corpusloom.plans.queries import K, MAX_RATING, NOW

# The same patterns as the engine's, in the other dialect.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
NOT_WS_BRACKET = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}\]]"
CAT = r"\[\[(?:Category|カテゴリ):([^\]|]+)(?:\|[^\]]*)?\]\]"
ISO = NOW.replace(" ", "T") + "Z"
CJK = r"[\p{Han}\p{Hiragana}\p{Katakana}ーｦ-ﾟ々]"


def _re(text: str, pattern: str, to: str = " ", options: str = "g") -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', '{options}')"


def _collapse(text: str) -> str:
    return f"trim({_re(text, WS + '+')})"


def _templates(text: str) -> str:
    for _ in range(3):
        text = _re(text, r"\{\{[^{}]*\}\}")
    return text


def _entities(text: str) -> str:
    """The entities that occur in the given pages.

    These old ones also count without their semicolon, as in a title cut off inside one. The
    ampersand comes last, so that nothing is replaced twice.
    """
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = _re(text, f"&{entity};?", char)
    return text


STEPS = {
    "strip_comments": lambda t: _re(t, "<!--.*?-->", options="gs"),
    "strip_paired_refs": lambda t: _re(t, "<ref[^>]*>.*?</ref>", options="gs"),
    "strip_selfclosing_refs": lambda t: _re(t, "<ref[^/]*/>"),
    "strip_tags": lambda t: _re(t, "<[^>]+>"),
    "strip_templates": _templates,
    "strip_media_category_links": lambda t: _re(t, r"\[\[(?:File|ファイル|Image|Category|カテゴリ):[^\]]+\]\]"),
    "unwrap_external_links": lambda t: _re(t, rf"\[https?://{NOT_WS_BRACKET}+{WS}*([^\]]*)\]", r" \1 "),
    "unwrap_piped_links": lambda t: _re(t, r"\[\[([^\]|]+)\|([^\]]+)\]\]", r" \2 "),
    "unwrap_links": lambda t: _re(t, r"\[\[([^\]]+)\]\]", r" \1 "),
    "unwrap_headings": lambda t: _re(t, rf"(?m)^=+{WS}*(.*?){WS}*=+$", r" \1 "),
    "strip_emphasis": lambda t: f"replace(replace({t}, '''''''', ' '), '''''', ' ')",
}


def _clean(text: str) -> str:
    for step in STEPS.values():
        text = step(text)
    return _collapse(_entities(text))


ORACLES: dict[str, str] = {}

for _name, _step in STEPS.items():
    ORACLES[_name] = with_fixtures(f"SELECT page_id, {_step('text')} AS text FROM fx_pages", "fx_pages")
ORACLES["collapse_ws"] = with_fixtures(f"SELECT page_id, {_collapse('text')} AS text FROM fx_pages", "fx_pages")
ORACLES["truncate_body"] = with_fixtures("SELECT page_id, substr(text, 1, 5000) AS text FROM fx_pages", "fx_pages")
ORACLES["html_unescape"] = f"SELECT page_id, {_entities('html')} AS html FROM pages"
ORACLES["strip_wikitext"] = with_fixtures(f"SELECT page_id, {_clean('text')} AS body FROM fx_pages", "fx_pages")
ORACLES["strip_wikitext_html"] = f"SELECT page_id, {_clean('html')} AS body FROM pages"
_URL = "concat('https://ja.wikipedia.org/wiki/', replace(url_encode(replace({}, ' ', '_')), '%2F', '/'))"
ORACLES["wiki_url"] = f"SELECT page_id, {_URL.format('url')} AS url FROM pages"


def _normal(name: str) -> str:
    return f"trim({_re(f'''replace({name}, '_', ' ')''', WS + '+')})"


ORACLES["normalize_category"] = f"SELECT doc_id, {_normal('text')} AS name FROM documents"
_FROM_TITLE = _normal("CASE WHEN contains(title, ':') THEN substr(title, strpos(title, ':') + 1) ELSE title END")
ORACLES["category_from_title"] = with_fixtures(
    f"SELECT page_id, {_FROM_TITLE} AS name FROM fx_category_pages", "fx_category_pages"
)


def _names(table: str, where: str = "true") -> str:
    """Normalized category names of a page with the place each was first seen."""
    return f"""SELECT page_id, name, min(i) AS pos FROM (
        SELECT page_id, i, {_normal('raw')} AS name FROM (
          SELECT page_id, unnest(m) AS raw, generate_subscripts(m, 1) AS i FROM (
            SELECT page_id, regexp_extract_all(text, '{CAT}', 1) AS m FROM {table} WHERE {where})))
      WHERE name <> '' GROUP BY page_id, name"""


ORACLES["extract_categories"] = with_fixtures(
    f"""WITH n AS ({_names('fx_pages')})
    SELECT p.page_id, coalesce(string_agg(name, '|' ORDER BY pos), '') AS names
    FROM fx_pages p LEFT JOIN n ON n.page_id = p.page_id GROUP BY p.page_id""",
    "fx_pages",
)
ORACLES["dedupe_keep_order"] = """
    WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
        generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
      f AS (SELECT doc_id, word, min(i) AS i FROM w GROUP BY doc_id, word)
    SELECT doc_id, string_agg(word, '|' ORDER BY i) AS words FROM f GROUP BY doc_id"""

# --- filters ---

_KEPT = "NOT redirect AND title <> '' AND text <> ''"
_ART = f"""art AS (SELECT * FROM (SELECT page_id, title, text, {_clean('text')} AS body FROM fx_pages
    WHERE ns = 0 AND {_KEPT}) WHERE body <> '')"""
ORACLES["filter_articles"] = with_fixtures(f"WITH {_ART} SELECT page_id, title, body FROM art", "fx_pages")
_CATPAGES = f"""catnames AS ({_names('fx_category_pages', f'ns = 14 AND {_KEPT}')}),
    catpages AS (SELECT page_id, {_FROM_TITLE} AS category FROM fx_category_pages
      WHERE ns = 14 AND {_KEPT} AND page_id IN (SELECT page_id FROM catnames))"""
ORACLES["filter_category_pages"] = with_fixtures(
    f"""WITH {_CATPAGES} SELECT c.page_id, category, string_agg(name, '|' ORDER BY pos) AS parents
    FROM catpages c JOIN catnames n ON n.page_id = c.page_id WHERE category <> '' GROUP BY c.page_id, category""",
    "fx_category_pages",
)
ORACLES["limit_rows"] = with_fixtures("SELECT page_id, title FROM fx_corpus ORDER BY page_id LIMIT 100", "fx_corpus")
ORACLES["keyset_page"] = with_fixtures(
    "SELECT page_id, title FROM fx_corpus WHERE page_id > 99 ORDER BY page_id LIMIT 50", "fx_corpus"
)
ORACLES["term_filter"] = with_fixtures("SELECT page_id, title FROM fx_corpus WHERE taxonomy_l1 = 'src7'", "fx_corpus")
ORACLES["source_includes"] = with_fixtures("SELECT page_id, title, taxonomy_l1 FROM fx_corpus", "fx_corpus")

# --- hierarchy and taxonomy ---

_HIER = f"""{_ART}, {_CATPAGES},
    lastpage AS (SELECT category, max(page_id) AS page_id FROM catpages WHERE category <> '' GROUP BY category),
    edges AS (SELECT category AS child, name AS parent,
        row_number() OVER (PARTITION BY category ORDER BY pos) - 1 AS pos
      FROM lastpage l JOIN catnames n ON n.page_id = l.page_id),
    direct AS (SELECT n.* FROM ({_names('fx_pages')}) n JOIN art USING (page_id)),
    up1 AS (SELECT d.page_id, e.parent AS name, d.pos AS p0, e.pos AS p1 FROM direct d JOIN edges e ON e.child = d.name),
    level1 AS (SELECT page_id, name, min(p0 * 1000 + p1) AS pos FROM up1
      WHERE (page_id, name) NOT IN (SELECT page_id, name FROM direct) GROUP BY page_id, name),
    level2 AS (SELECT page_id, e.parent AS name, min((p0 * 1000 + p1) * 1000 + e.pos) AS pos
      FROM up1 u JOIN edges e ON e.child = u.name
      WHERE (page_id, e.parent) NOT IN (SELECT page_id, name FROM direct)
        AND (page_id, e.parent) NOT IN (SELECT page_id, name FROM level1) GROUP BY page_id, e.parent),
    alls AS (SELECT page_id, name, 0 AS lvl, pos FROM direct UNION ALL SELECT page_id, name, 1, pos FROM level1
      UNION ALL SELECT page_id, name, 2, pos FROM level2)"""
_HIER_FX = ("fx_pages", "fx_category_pages")


def _hier(body: str, *more: str) -> str:
    return with_fixtures(f"WITH {_HIER}{body}", *_HIER_FX, *more)


def _level_list(condition: str, name: str) -> str:
    return f"coalesce(string_agg(name, '|' ORDER BY lvl, pos) FILTER (WHERE {condition}), '') AS {name}"


_LISTS = {
    "categories_direct": "lvl = 0",
    "categories_level1": "lvl = 1",
    "categories_level2": "lvl = 2",
    "categories_all": "lvl IS NOT NULL",
}
ORACLES["category_edges"] = _hier(" SELECT child, parent, pos FROM edges")
for _query, _list in (
    ("parents_level1", "categories_level1"),
    ("parents_level2", "categories_level2"),
    ("categories_all", "categories_all"),
):
    ORACLES[_query] = _hier(
        f" SELECT art.page_id, {_level_list(_LISTS[_list], _list)} FROM art LEFT JOIN alls USING (page_id) GROUP BY art.page_id"
    )
ORACLES["resolve_hierarchy"] = _hier(
    f" SELECT art.page_id, {', '.join(_level_list(c, n) for n, c in _LISTS.items())}"
    " FROM art LEFT JOIN alls USING (page_id) GROUP BY art.page_id"
)
_TAX = """,
    corpus AS (SELECT page_id, concat_ws(' ', any_value(title), string_agg(name, ' ' ORDER BY lvl, pos)) AS corpus
      FROM art LEFT JOIN alls USING (page_id) GROUP BY page_id),
    found AS (SELECT page_id, rule_ord, l1, l2, keyword FROM corpus, fx_rules WHERE contains(corpus, keyword)),
    hit AS (SELECT * FROM found WHERE (page_id, rule_ord) IN (SELECT page_id, min(rule_ord) FROM found GROUP BY page_id)),
    in_list AS (SELECT h.page_id, arg_min(name, lvl * 1000000000000 + pos) AS name
      FROM hit h JOIN alls a ON a.page_id = h.page_id AND contains(a.name, h.keyword) GROUP BY h.page_id),
    first_direct AS (SELECT page_id, arg_min(name, pos) AS name FROM direct GROUP BY page_id),
    rule AS (SELECT DISTINCT page_id, l1, l2 FROM hit),
    classified AS (SELECT art.page_id, title, coalesce(l1, 'その他') AS taxonomy_l1, coalesce(l2, '未分類') AS taxonomy_l2,
        coalesce(i.name, f.name, l2, '未分類') AS taxonomy_l3
      FROM art LEFT JOIN rule USING (page_id) LEFT JOIN in_list i USING (page_id) LEFT JOIN first_direct f USING (page_id))"""
ORACLES["classify_taxonomy"] = _hier(_TAX + " SELECT page_id, taxonomy_l1, taxonomy_l2, taxonomy_l3 FROM classified", "fx_rules")
ORACLES["classify_by_index"] = ORACLES["classify_taxonomy"]
ORACLES["classify_many_keywords"] = with_fixtures(
    """WITH art AS (SELECT page_id, title, string_split(direct, '|') AS direct, string_split(everything, '|') AS everything FROM fx_named),
      corpus AS (SELECT page_id, concat_ws(' ', title, array_to_string(everything, ' ')) AS corpus FROM art),
      found AS (SELECT page_id, rule_ord, l1, l2, keyword FROM corpus, fx_keywords WHERE contains(corpus, keyword)),
      hit AS (SELECT * FROM found WHERE (page_id, rule_ord) IN (SELECT (page_id, min(rule_ord)) FROM found GROUP BY page_id)),
      names AS (SELECT page_id, unnest(direct) AS name, generate_subscripts(direct, 1) AS place FROM art
        UNION ALL SELECT page_id, unnest(everything), 1000 + generate_subscripts(everything, 1) FROM art),
      third AS (SELECT page_id, arg_min(name, place) AS name FROM names JOIN hit USING (page_id) WHERE contains(name, keyword) GROUP BY page_id),
      rule AS (SELECT DISTINCT page_id, l1, l2 FROM hit)
    SELECT page_id, coalesce(l1, 'その他') AS taxonomy_l1, coalesce(l2, '未分類') AS taxonomy_l2, coalesce(name, direct[1]) AS taxonomy_l3
    FROM art LEFT JOIN rule USING (page_id) LEFT JOIN third USING (page_id)""",
    "fx_named",
    "fx_keywords",
)
ORACLES["build_articles"] = _hier(
    _TAX
    + f""" SELECT c.page_id, c.title, body, {_URL.format('c.title')} AS url, categories_all,
      taxonomy_l1, taxonomy_l2, taxonomy_l3
    FROM classified c JOIN art USING (page_id) JOIN (SELECT art.page_id, {_level_list(_LISTS['categories_all'], 'categories_all')}
      FROM art LEFT JOIN alls USING (page_id) GROUP BY art.page_id) USING (page_id)""",
    "fx_rules",
)
ORACLES["term_filter_multi"] = _hier(" SELECT count(DISTINCT page_id) AS count FROM alls WHERE name = 'root'")
ORACLES["count_in_category"] = _hier(" SELECT count(DISTINCT page_id) AS count FROM alls WHERE name = 'en'")
ORACLES["category_coverage"] = _hier(
    """ SELECT (SELECT count(*) FROM fx_pages) + (SELECT count(*) FROM fx_category_pages) AS scanned,
    count(*) AS mapped_pages, count(DISTINCT category) AS mapped FROM catpages WHERE category <> ''"""
)

# --- facets ---

for _level, _n in ((1, 20), (2, 30), (3, 30)):
    ORACLES[f"terms_l{_level}"] = with_fixtures(
        f"""SELECT taxonomy_l{_level} AS key, count(*) AS doc_count FROM fx_facets WHERE taxonomy_l{_level} IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {_n}""",
        "fx_facets",
    )


def _drilldown(table: str) -> str:
    return f""" a AS (SELECT taxonomy_l1, count(*) AS count_1 FROM {table} WHERE taxonomy_l1 IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15),
      b AS (SELECT *, row_number() OVER (PARTITION BY taxonomy_l1 ORDER BY count_2 DESC, taxonomy_l2) AS r2
        FROM (SELECT taxonomy_l1, taxonomy_l2, count(*) AS count_2 FROM {table} GROUP BY 1, 2)),
      c AS (SELECT *, row_number() OVER (PARTITION BY taxonomy_l1, taxonomy_l2 ORDER BY count_3 DESC, taxonomy_l3) AS r3
        FROM (SELECT taxonomy_l1, taxonomy_l2, taxonomy_l3, count(*) AS count_3 FROM {table} GROUP BY 1, 2, 3))
    SELECT taxonomy_l1, count_1, taxonomy_l2, count_2, taxonomy_l3, count_3
    FROM a JOIN b USING (taxonomy_l1) JOIN c USING (taxonomy_l1, taxonomy_l2) WHERE r2 <= 10 AND r3 <= 10"""


ORACLES["drilldown_3level"] = with_fixtures("WITH" + _drilldown("fx_facets"), "fx_facets")
ORACLES["drilldown_articles"] = _hier(_TAX + "," + _drilldown("classified"), "fx_rules")
ORACLES["top_hits_per_bucket"] = with_fixtures(
    """WITH a AS (SELECT taxonomy_l1, count(*) AS doc_count FROM fx_facets WHERE taxonomy_l1 IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12),
      r AS (SELECT *, row_number() OVER (PARTITION BY taxonomy_l1 ORDER BY page_id) AS hit FROM fx_facets)
    SELECT page_id, title, taxonomy_l1, taxonomy_l2, taxonomy_l3, doc_count, hit FROM r JOIN a USING (taxonomy_l1) WHERE hit <= 3""",
    "fx_facets",
)
for _query, _l1, _table in (
    ("filtered_multi_terms", "A", "direct"),
    ("level_facets", "A", "level1"),
    ("level2_facets", "B", "level2"),
):
    ORACLES[_query] = _hier(
        _TAX
        + f""" SELECT name AS key, count(DISTINCT page_id) AS doc_count FROM {_table} JOIN classified USING (page_id)
        WHERE taxonomy_l1 = '{_l1}' GROUP BY name ORDER BY 2 DESC, 1 LIMIT 30""",
        "fx_rules",
    )
ORACLES["breakdown_l1_l2_l3"] = with_fixtures(
    """SELECT taxonomy_l1, taxonomy_l2, taxonomy_l3, grouping(taxonomy_l1, taxonomy_l2, taxonomy_l3) AS level,
      count(*) AS doc_count FROM fx_facets GROUP BY ROLLUP (taxonomy_l1, taxonomy_l2, taxonomy_l3)""",
    "fx_facets",
)
ORACLES["terms_other_count"] = with_fixtures(
    """SELECT CAST((SELECT count(*) FROM fx_facets) - sum(n) AS BIGINT) AS sum_other_doc_count FROM (
      SELECT count(*) AS n FROM fx_facets GROUP BY taxonomy_l3 ORDER BY n DESC, taxonomy_l3 LIMIT 30)""",
    "fx_facets",
)
ORACLES["distinct_tags"] = with_fixtures(
    """SELECT key, count(*) AS doc_count FROM (
      SELECT unnest(string_split(tags, ',')) AS key FROM fx_scenarios WHERE workspace_id = 'w0')
    GROUP BY key ORDER BY 2 DESC, 1 LIMIT 100""",
    "fx_scenarios",
)

# --- sources and sinks ---

ORACLES["scan_dump"] = with_fixtures(
    """SELECT page_id, title, ns, redirect, text FROM fx_pages
    UNION ALL SELECT page_id, title, ns, redirect, text FROM fx_category_pages""",
    "fx_pages",
    "fx_category_pages",
)
ORACLES["read_custom_docs"] = f"""
    SELECT page_id, url AS title, html AS body, '' AS url, '{ISO}' AS fetched_at FROM pages
    WHERE NOT contains(url, 'example.net') AND NOT contains(url, 'example.org')"""
ORACLES["reject_custom_docs"] = """
    SELECT contains(url, 'example.org') AS unreadable, count(*) AS n FROM pages
    WHERE contains(url, 'example.net') OR contains(url, 'example.org') GROUP BY 1"""
ORACLES["write_bulk_ndjson"] = """
    SELECT 2 * count(*) AS lines, count(*) AS actions, count(*) AS docs,
      CAST(sum(length(text)) AS BIGINT) AS body_chars FROM documents"""
ORACLES["read_bulk_ndjson"] = with_fixtures(
    f"""SELECT CAST(page_id AS VARCHAR) AS _id, page_id, title, body, '{ISO}' AS fetched_at, taxonomy_l1 FROM fx_corpus""",
    "fx_corpus",
)
ORACLES["read_bulk_ndjson_by_line"] = ORACLES["read_bulk_ndjson"]
ORACLES["read_pages_table"] = ORACLES["source_includes"]
ORACLES["pack_by_bytes"] = with_fixtures(
    """WITH RECURSIVE s AS (SELECT page_id, strlen(body) AS bytes, page_id // 300 AS bucket,
        row_number() OVER (PARTITION BY page_id // 300 ORDER BY page_id) AS i FROM fx_corpus),
      p AS (SELECT page_id, bytes, bucket, i, CAST(0 AS BIGINT) AS part, CAST(bytes AS BIGINT) AS used FROM s WHERE i = 1
        UNION ALL
        SELECT s.page_id, s.bytes, s.bucket, s.i,
          CASE WHEN p.used + s.bytes > 20000 THEN p.part + 1 ELSE p.part END,
          CASE WHEN p.used + s.bytes > 20000 THEN s.bytes ELSE p.used + s.bytes END
        FROM p JOIN s ON s.bucket = p.bucket AND s.i = p.i + 1)
    SELECT page_id, bytes, bucket, part FROM p""",
    "fx_corpus",
)
ORACLES["pack_requests"] = with_fixtures(
    """WITH RECURSIVE s AS (SELECT page_id, strlen(body) AS bytes, page_id // 300 AS bucket,
        row_number() OVER (PARTITION BY page_id // 300 ORDER BY page_id) AS i FROM fx_corpus),
      p AS (SELECT page_id, bytes, bucket, i, CAST(0 AS BIGINT) AS part, CAST(bytes AS BIGINT) AS used,
          CAST(0 AS BIGINT) AS request, CAST(bytes AS BIGINT) AS asked FROM s WHERE i = 1
        UNION ALL
        SELECT s.page_id, s.bytes, s.bucket, s.i,
          CASE WHEN p.used + s.bytes > 60000 THEN p.part + 1 ELSE p.part END,
          CASE WHEN p.used + s.bytes > 60000 THEN s.bytes ELSE p.used + s.bytes END,
          CASE WHEN p.used + s.bytes > 60000 THEN 0 WHEN p.asked + s.bytes > 9000 THEN p.request + 1 ELSE p.request END,
          CASE WHEN p.used + s.bytes > 60000 OR p.asked + s.bytes > 9000 THEN s.bytes ELSE p.asked + s.bytes END
        FROM p JOIN s ON s.bucket = p.bucket AND s.i = p.i + 1)
    SELECT page_id, printf('%08d-%06d', bucket, part) AS part_no, request FROM p""",
    "fx_corpus",
)
ORACLES["pack_requests_uncapped"] = with_fixtures(
    """WITH RECURSIVE s AS (SELECT page_id, strlen(body) AS bytes, page_id // 300 AS bucket,
        row_number() OVER (PARTITION BY page_id // 300 ORDER BY page_id) AS i FROM fx_corpus),
      p AS (SELECT page_id, bucket, i, CAST(0 AS BIGINT) AS request, CAST(bytes AS BIGINT) AS asked FROM s WHERE i = 1
        UNION ALL
        SELECT s.page_id, s.bucket, s.i, CASE WHEN p.asked + s.bytes > 9000 THEN p.request + 1 ELSE p.request END,
          CASE WHEN p.asked + s.bytes > 9000 THEN s.bytes ELSE p.asked + s.bytes END
        FROM p JOIN s ON s.bucket = p.bucket AND s.i = p.i + 1)
    SELECT page_id, bucket, request FROM p""",
    "fx_corpus",
)
ORACLES["reject_bulk_ndjson"] = with_fixtures(
    """SELECT problem, count(*) AS n, CAST(sum(CASE WHEN problem = '' THEN length(body) ELSE 0 END) AS BIGINT) AS chars
    FROM (SELECT body, CASE page_id % 5 WHEN 2 THEN 'the action names no document id'
        WHEN 3 THEN 'the document line is no JSON object of the document fields' ELSE '' END AS problem FROM fx_corpus)
    GROUP BY problem""",
    "fx_corpus",
)
_UPSERTED = """upserted AS (
    SELECT page_id, title, body, taxonomy_l1 FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq DESC) AS r
      FROM (SELECT page_id, title, body, taxonomy_l1, 0 AS seq FROM fx_corpus
        UNION ALL SELECT page_id, title, body, taxonomy_l1, seq FROM fx_delta)) WHERE r = 1)"""
ORACLES["upsert_pages"] = with_fixtures(f"WITH {_UPSERTED} SELECT * FROM upserted", "fx_corpus", "fx_delta")
ORACLES["publish_snapshot"] = with_fixtures(
    f"WITH {_UPSERTED} SELECT page_id, title, taxonomy_l1, 'articles-20260402-1' AS snapshot FROM upserted",
    "fx_corpus",
    "fx_delta",
)
ORACLES["union_custom"] = with_fixtures(
    """SELECT page_id, title, body, taxonomy_l1 FROM fx_corpus WHERE page_id NOT IN (SELECT page_id FROM fx_custom)
    UNION ALL SELECT page_id, title, body, NULL FROM
      (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq DESC) AS r FROM fx_custom) WHERE r = 1""",
    "fx_corpus",
    "fx_custom",
)
ORACLES["reingest_full"] = with_fixtures(
    f"""WITH {_UPSERTED}
    SELECT page_id, title, body, taxonomy_l1, 'articles-20260402-1' AS snapshot FROM upserted
      WHERE page_id NOT IN (SELECT page_id FROM fx_custom)
    UNION ALL SELECT page_id, title, body, NULL, 'articles-20260402-1' FROM
      (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq DESC) AS r FROM fx_custom) WHERE r = 1""",
    "fx_corpus",
    "fx_delta",
    "fx_custom",
)
ORACLES["stream_custom_docs"] = ORACLES["union_custom"]
ORACLES["apply_schema_contract"] = with_fixtures(
    f"""SELECT CASE WHEN NOT redirect THEN page_id END AS page_id, title, text AS body, CAST(NULL AS VARCHAR) AS url,
      CASE WHEN NOT redirect THEN '{ISO}' END AS fetched_at, title AS categories_direct, CAST(NULL AS VARCHAR) AS taxonomy_l1
    FROM fx_pages""",
    "fx_pages",
)
ORACLES["contract_violations"] = with_fixtures(
    """SELECT field, CASE WHEN field IN ('page_id', 'fetched_at') THEN (SELECT count(*) FROM fx_pages WHERE redirect)
      ELSE 0 END AS violations
    FROM (SELECT unnest(['page_id', 'title', 'body', 'url', 'fetched_at', 'categories_direct', 'categories_level1',
      'categories_level2', 'categories_all', 'taxonomy_l1', 'taxonomy_l2', 'taxonomy_l3']) AS field)""",
    "fx_pages",
)
ORACLES["rows_to_docs"] = with_fixtures(
    f"""SELECT CASE WHEN NOT redirect THEN page_id END AS page_id, title,
      CASE WHEN contains(text, '[[Category:fr]]') THEN text ELSE '' END AS body, '' AS url,
      CASE WHEN redirect THEN '2026-01-01T00:00:00Z' ELSE '{ISO}' END AS fetched_at, title AS categories_direct,
      '' AS categories_level1, '' AS categories_level2, '' AS categories_all,
      '' AS taxonomy_l1, '' AS taxonomy_l2, '' AS taxonomy_l3 FROM fx_pages""",
    "fx_pages",
)
ORACLES["encode_list_columns"] = r"""
    SELECT doc_id, concat('["', replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), ' ', '","'), '"]') AS words
    FROM documents"""

# --- text analysis ---


LETTERS = r"\p{L}+"


def _tokens(expression: str, source: str = "documents") -> str:
    query = f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n, array_to_string(t, '|') AS tokens
        FROM (SELECT doc_id, {expression} AS t FROM {source})"""
    return with_fixtures(query, source) if source.startswith("fx_") else query


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_SIMPLE = r"regexp_extract_all(lower(text), '\p{L}+')"
ORACLES["tok_whitespace"] = _tokens(r"regexp_extract_all(text, '\S+')")
ORACLES["tok_simple"] = _tokens(_SIMPLE)
ORACLES["tok_stop"] = _tokens(f"list_filter({_SIMPLE}, lambda w: w NOT IN ({_quoted(an.ENGLISH_STOP_WORDS)}))")
ORACLES["tok_keyword"] = _tokens("CASE WHEN text = '' THEN [] ELSE [text] END")
ORACLES["tok_pattern"] = _tokens("regexp_extract_all(lower(text), '[a-z0-9_]+')")
#: The word-break rules as a grammar: letters joined by marks between letters, digits by marks between digits.
_MARKED_LETTERS = r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Nl}]"


def _word_grammar() -> str:
    letter, extend = _MARKED_LETTERS, f"[{wb.EXTEND}]"
    letters, digits = rf"{letter}(?:{letter}|{extend})*", rf"[{wb.NUMERIC}][{wb.NUMERIC}{wb.EXTEND}]*"
    between_letters, between_digits = f"[{wb.MID_LETTER}{wb.MID_NUM_LET}]{extend}*", f"[{wb.MID_NUM}{wb.MID_NUM_LET}]{extend}*"
    plain = f"(?:{letters}(?:{between_letters}{letters})*|{digits}(?:{between_digits}{digits})*)+"
    core = f"(?:{plain}|[{wb.KANA}][{wb.KANA}{wb.EXTEND}]*)"
    joint = f"[{wb.EXTEND_NUM_LET}]{extend}*"
    return f"(?:{joint})*{core}(?:(?:{joint})+{core})*(?:{joint})*|[{wb.HAN}{wb.HIRAGANA}]{extend}*".replace("'", "''")


_WORD = _word_grammar()
ORACLES["tok_standard"] = _tokens(f"regexp_extract_all(lower(text), '{_WORD}')", "fx_ja")
ORACLES["tok_standard_marks"] = _tokens(f"regexp_extract_all(lower(text), '{_WORD}')", "fx_marked")
_BIGRAMS = rf"""flatten(list_transform(regexp_extract_all(text, '{CJK}+|[\p{{Latin}}\p{{N}}]+'),
    lambda run: CASE WHEN regexp_full_match(run, '{CJK}{{2,}}')
      THEN list_transform(range(1, length(run)), lambda i: substr(run, i, 2)) ELSE [run] END))"""
ORACLES["tok_cjk_bigram"] = _tokens(_BIGRAMS, "fx_ja")
_JA_STOP = f"NOT IN ({_quoted(an.JAPANESE_STOP_WORDS)})"
ORACLES["ja_stopwords"] = _tokens(f"list_filter({_BIGRAMS}, lambda w: w {_JA_STOP})", "fx_ja")
_STEM = "regexp_replace({}, '^([ァ-ヺー]{{3,}})ー$', '\\1')"
_WORDS = r"regexp_extract_all(text, '\S+')"
ORACLES["katakana_stem"] = _tokens(f"list_transform({_WORDS}, lambda w: {_STEM.format('w')})", "fx_ja")
ORACLES["lowercase_tokens"] = _tokens(f"list_transform({_WORDS}, lambda w: lower(w))", "fx_ja")
ORACLES["drop_punctuation"] = _tokens(rf"list_filter({_WORDS}, lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]'))", "fx_ja")


def _fold(text: str) -> str:
    """The width rule, as far as the data goes: it holds ｶ and ﾞ but no other half-width kana."""
    wide, plain = an.FULL_WIDTH_ASCII, an.ASCII.replace("'", "''")
    out = f"translate({text}, '{wide}ｶ', '{plain}カ')"
    for base in an.VOICED_BASES:
        out = f"replace({out}, '{base}ﾞ', '{chr(ord(base) + 1)}')"
    for base, voiced in (("ウ", "ヴ"), ("ワ", "ヷ"), ("ヲ", "ヺ")):
        out = f"replace({out}, '{base}ﾞ', '{voiced}')"
    return f"replace({out}, 'ﾞ', chr(12441))"


ORACLES["width_fold"] = with_fixtures(
    f"SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, {_fold('text')} FROM fx_ja", "fx_ja"
)
ORACLES["analyze_corpus"] = with_fixtures(
    rf"""WITH t AS (SELECT doc_id, list_filter(list_transform(
          list_filter({_BIGRAMS}, lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')),
          lambda w: {_fold('w')}), lambda w: w {_JA_STOP}) AS t FROM fx_ja),
      r AS (SELECT unnest(t) AS w, generate_subscripts(t, 1) - 1 AS position FROM t)
    SELECT lower({_STEM.format('w')}) AS token, count(*) AS n, CAST(sum(position) AS BIGINT) AS positions FROM r GROUP BY 1""",
    "fx_ja",
)
_TOKEN_ROWS = r"""runs AS (SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS run
      FROM (SELECT doc_id, regexp_extract_all(text, '\S+|\s+') AS m FROM documents)),
    ends AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY run) AS BIGINT) AS end_offset FROM runs),
    toks AS (SELECT doc_id, piece AS token, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS position,
        end_offset - length(piece) AS start_offset, end_offset
      FROM ends WHERE NOT regexp_matches(piece, '^\s'))"""
ORACLES["token_table"] = f"""WITH {_TOKEN_ROWS}
    SELECT doc_id, token, position, 1 AS position_length, start_offset, end_offset, 'word' AS type FROM toks"""


def _token_table(token: str, gap: str, source: str = "documents", fold: str = "lower(text)", dropped: list[str] = (), graph: bool = False) -> str:
    kept = f"WHERE token NOT IN ({_quoted(dropped)})" if dropped else ""
    columns = "doc_id, token, position, 1 AS position_length, start_offset, end_offset, 'word' AS type"
    if graph:
        columns = """doc_id, token, position AS src, position + 1 AS dst, 1 AS span, false AS is_multi, CAST(0 AS BIGINT) AS parallel"""
    query = rf"""WITH runs AS (SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS run
        FROM (SELECT doc_id, regexp_extract_all({fold}, '{token}|{gap}') AS m FROM {source})),
      ends AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY run) AS BIGINT) AS end_offset FROM runs),
      toks AS (SELECT doc_id, piece AS token, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS position,
          end_offset - length(piece) AS start_offset, end_offset
        FROM ends WHERE regexp_matches(piece, '^(?:{token})'))
    SELECT {columns} FROM toks {kept}"""
    return with_fixtures(query, source) if source.startswith("fx_") else query


ORACLES["token_table_simple"] = _token_table(r"\p{L}+", r"[^\p{L}]+")
ORACLES["token_table_stop"] = _token_table(r"\p{L}+", r"[^\p{L}]+", dropped=an.ENGLISH_STOP_WORDS)
ORACLES["token_graph_stop"] = _token_table(r"\p{L}+", r"[^\p{L}]+", dropped=an.ENGLISH_STOP_WORDS, graph=True)
ORACLES["token_table_pattern"] = _token_table("[a-z0-9_]+", "[^a-z0-9_]+")
for _query, _source in (("token_table_standard", "fx_ja"), ("token_table_marks", "fx_marked")):
    ORACLES[_query] = _token_table(_WORD, "(?s:.)", _source)

_LONGEST_WORD = range(1, segmentation.LONGEST + 1)
_SEGMENT = rf"""pcs AS (SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS run
      FROM (SELECT doc_id, regexp_extract_all(text, '{CJK}+|[\p{{Latin}}\p{{N}}]+|(?s:.)') AS m FROM fx_ja)),
    offs AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY run) AS BIGINT) - length(piece) AS start_offset FROM pcs),
    words AS (SELECT * FROM offs WHERE regexp_matches(piece, '^(?:{CJK}|[\p{{Latin}}\p{{N}}])')),
    runs AS (SELECT piece, count(*) AS n FROM words WHERE regexp_matches(piece, '^{CJK}') GROUP BY piece),
    subs AS (SELECT piece, n, e, l, substr(piece, CAST(e - l + 1 AS BIGINT), CAST(l AS BIGINT)) AS word
      FROM (SELECT piece, n, unnest(range(1, length(piece) + 1)) AS e FROM runs) JOIN (SELECT unnest(range(1, {segmentation.LONGEST + 1})) AS l) ON l <= e),
    total AS (SELECT sum(n * length(piece)) AS total FROM runs),
    counted AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM subs GROUP BY word),
    lexicon AS (SELECT word, n, CAST(floor(1000 * ln(total / n)) AS BIGINT) AS cost FROM counted, total
      WHERE length(word) = 1 OR n >= {segmentation.MIN_COUNT})"""
_LATTICE = f"""{_SEGMENT},
    opts AS (SELECT piece, e, {', '.join(f'max(CASE WHEN l = {k} THEN cost END) AS c{k}' for k in _LONGEST_WORD)}
      FROM subs LEFT JOIN lexicon USING (word) GROUP BY piece, e),
    ways AS (
      SELECT piece, CAST(0 AS BIGINT) AS e, CAST(0 AS BIGINT) AS s1, {', '.join(f'CAST(NULL AS BIGINT) AS s{k}' for k in _LONGEST_WORD if k > 1)},
        CAST([] AS INT[]) AS lasts FROM runs
      UNION ALL
      SELECT piece, e, best, {', '.join(f's{k}' for k in _LONGEST_WORD if k < segmentation.LONGEST)},
        list_append(lasts, CASE {' '.join(f'WHEN s{k} + c{k} = best THEN {k}' for k in reversed(_LONGEST_WORD))} END)
      FROM (SELECT w.piece, o.e, {', '.join(f's{k}, c{k}' for k in _LONGEST_WORD)}, lasts, least({', '.join(f's{k} + c{k}' for k in _LONGEST_WORD)}) AS best
        FROM ways w JOIN opts o ON o.piece = w.piece AND o.e = w.e + 1)),
    back AS (
      SELECT piece, e, lasts FROM ways WHERE e = length(piece)
      UNION ALL
      SELECT piece, e - lasts[e], lasts FROM back WHERE e > 0),
    cut AS (SELECT piece, e, lasts[e] AS l FROM back WHERE e > 0),
    segmented AS (SELECT doc_id, start_offset + coalesce(e - l, 0) AS start_offset,
        CASE WHEN e IS NULL THEN piece ELSE substr(piece, CAST(e - l + 1 AS BIGINT), CAST(l AS BIGINT)) END AS token
      FROM words LEFT JOIN cut USING (piece)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start_offset) - 1 AS position FROM segmented)"""
ORACLES["segment_lexicon"] = with_fixtures(f"WITH {_SEGMENT} SELECT word, n, cost FROM lexicon", "fx_ja")
ORACLES["segment_japanese"] = with_fixtures(
    f"""WITH RECURSIVE {_LATTICE} SELECT doc_id, token, position, 1 AS position_length, start_offset,
      start_offset + length(token) AS end_offset, 'word' AS type FROM placed""",
    "fx_ja",
)
ORACLES["analyze_segmented"] = with_fixtures(
    f"""WITH RECURSIVE {_LATTICE}, folded AS (SELECT {_fold('token')} AS w, position FROM placed)
    SELECT lower({_STEM.format('w')}) AS token, count(*) AS n, CAST(sum(position) AS BIGINT) AS positions FROM folded WHERE w {_JA_STOP} GROUP BY 1""",
    "fx_ja",
)

# Compounds of the words of all documents.
_SEQUENCES = " UNION ALL ".join(
    f"""SELECT doc_id, position, start_offset, {k} AS size, [token, {', '.join(f'lead(token, {i}) OVER w' for i in range(1, k))}] AS words,
      lead(end_offset, {k - 1}) OVER w AS end_offset FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY position)"""
    for k in range(2, collocations.LONGEST + 1)
)
_COMPOUNDS = rf"""runs AS (SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS run
      FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+|[^\p{{L}}]+') AS m FROM documents)),
    ends AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY run) AS BIGINT) AS end_offset FROM runs),
    toks AS (SELECT doc_id, piece AS token, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS position,
        end_offset - length(piece) AS start_offset, end_offset FROM ends WHERE regexp_matches(piece, '^\p{{L}}')),
    seqs AS (SELECT * FROM ({_SEQUENCES}) WHERE end_offset IS NOT NULL),
    counts AS (SELECT token, count(*) AS n FROM toks GROUP BY token),
    often AS (SELECT words, size, count(*) AS n FROM seqs GROUP BY words, size HAVING count(*) >= {collocations.MIN_COUNT}),
    single AS (SELECT words, size, o.n, sum(CAST(ln(c.n) AS DECIMAL(18, 9))) AS single
      FROM (SELECT *, unnest(words) AS token FROM often) o JOIN counts c USING (token) GROUP BY words, size, o.n),
    compounds AS (SELECT array_to_string(words, ' ') AS token, words, size, n,
        round(CAST(CAST(ln(n) AS DECIMAL(18, 9)) + CAST(ln((SELECT count(*) FROM toks)) AS DECIMAL(18, 9)) * (size - 1) - single AS DOUBLE) / (size - 1), 6) AS pmi
      FROM single),
    kept AS (SELECT * FROM compounds WHERE pmi >= {collocations.MIN_PMI}),
    graph AS (SELECT doc_id, token, position, 1 AS position_length, start_offset, end_offset, 'word' AS type FROM toks
      UNION ALL SELECT doc_id, token, position, s.size, start_offset, end_offset, 'compound' FROM seqs s JOIN kept k USING (words))"""
ORACLES["collocations"] = f"WITH {_COMPOUNDS} SELECT token, size, n, pmi FROM kept"
ORACLES["token_table_compounds"] = f"WITH {_COMPOUNDS} SELECT * FROM graph"
ORACLES["token_graph_nodes"] = f"""WITH {_COMPOUNDS},
    nodes AS (SELECT doc_id, position AS node FROM graph UNION SELECT doc_id, position + position_length FROM graph)
    SELECT doc_id, node, row_number() OVER (PARTITION BY doc_id ORDER BY node) - 1 AS index FROM nodes"""
ORACLES["token_graph_edges"] = f"""WITH {_COMPOUNDS}
    SELECT doc_id, token, position AS src, position + position_length AS dst, position_length AS span, position_length > 1 AS is_multi,
      row_number() OVER (PARTITION BY doc_id, position, position_length ORDER BY start_offset) - 1 AS parallel FROM graph"""
_INTO = ", ".join(f"count(*) FILTER (position_length = {k}) AS i{k}" for k in range(1, collocations.LONGEST + 1))
_WAYS = " + ".join(f"w{k} * i{k}" for k in range(1, collocations.LONGEST + 1))
ORACLES["token_graph_paths"] = f"""WITH RECURSIVE {_COMPOUNDS},
    spanned AS (SELECT DISTINCT doc_id, unnest(range(position + 1, position + position_length)) AS node FROM graph WHERE position_length > 1),
    nodes AS (SELECT doc_id, position AS node FROM graph UNION SELECT doc_id, position + position_length FROM graph),
    cuts AS (SELECT doc_id, node AS dst, lag(node) OVER (PARTITION BY doc_id ORDER BY node) AS src
      FROM nodes WHERE (doc_id, node) NOT IN (SELECT (doc_id, node) FROM spanned)),
    stretches AS (SELECT doc_id, src, dst FROM cuts WHERE dst - src > 1),
    inside AS (SELECT s.doc_id, s.src, s.dst, count(*) AS edges FROM stretches s JOIN graph g
        ON g.doc_id = s.doc_id AND g.position >= s.src AND g.position + g.position_length <= s.dst GROUP BY ALL),
    into_ AS (SELECT doc_id, position + position_length AS node, {_INTO} FROM graph GROUP BY ALL),
    walk AS (SELECT doc_id, src, dst, src AS here, CAST(1 AS BIGINT) AS w1, CAST(0 AS BIGINT) AS w2, CAST(0 AS BIGINT) AS w3 FROM stretches
      UNION ALL
      SELECT walk.doc_id, walk.src, walk.dst, node, ({_WAYS}) % {collocations.WAYS}, w1, w2
      FROM walk JOIN into_ i ON i.doc_id = walk.doc_id AND i.node = walk.here + 1 WHERE here < dst)
    SELECT inside.doc_id, inside.src, inside.dst, edges, w1 AS ways
    FROM inside JOIN walk ON walk.doc_id = inside.doc_id AND walk.src = inside.src AND walk.here = inside.dst"""
ORACLES["token_table_keyword"] = """
    SELECT doc_id, text AS token, CAST(0 AS BIGINT) AS position, 1 AS position_length, CAST(0 AS BIGINT) AS start_offset,
      length(text) AS end_offset, 'word' AS type FROM documents WHERE text <> ''"""
ORACLES["build_postings"] = r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS t FROM documents)
    SELECT term, doc_id, count(*) AS tf, CAST(any_value(doc_len) AS BIGINT) AS doc_len
    FROM (SELECT doc_id, len(t) AS doc_len, unnest(t) AS term FROM t) GROUP BY term, doc_id"""


def _bm25(docs: str, queries: str, key: str, pattern: str, stop: list[str] = (), query: str = "query_id") -> str:
    words = f"regexp_extract_all(lower(text), '{pattern}')"
    if stop:
        words = f"list_filter({words}, lambda w: w NOT IN ({_quoted(stop)}))"
    return rf"""d AS (SELECT {key}, {words} AS t FROM {docs}),
      n AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM d WHERE len(t) > 0),
      tf AS (SELECT {key}, term, count(*) AS tf, any_value(dl) AS dl
        FROM (SELECT {key}, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY {key}, term),
      df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
      q AS (SELECT query_id, term, count(*) AS qtf
        FROM (SELECT {query} AS query_id, unnest({words}) AS term FROM {queries}) GROUP BY query_id, term),
      s AS (SELECT query_id, {key}, sum(CAST(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * {K1 + 1}
          / (tf + {K1} * (1 - {B} + {B} * dl / mean))) AS DECIMAL(28, 12))) AS score
        FROM q JOIN tf USING (term) JOIN df USING (term), n GROUP BY query_id, {key}),
      r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS rank, {key}, score FROM s)
    SELECT query_id, rank, {key}, round(CAST(score AS DOUBLE), 6) AS score FROM r WHERE rank <= {K}"""


def _scoped(workspace: str) -> str:
    """One workspace's search over its own records."""
    return f"""SELECT '{workspace}' AS workspace_id, * FROM (WITH rec AS (SELECT scenario_id AS record_id,
        concat_ws(' ', replace(params, ',', ' '), replace(tags, ',', ' '), text) AS text
        FROM fx_scenarios WHERE workspace_id = '{workspace}'),
      asked AS (SELECT query_id, text FROM fx_scoped_queries WHERE workspace_id = '{workspace}'),
      """ + _bm25("rec", "asked", "record_id", _WORD) + ")"


ORACLES["bm25_topk"] = with_fixtures("WITH " + _bm25("documents", "fx_queries", "doc_id", r"\p{L}+"), "fx_queries")
ORACLES["metadata_search"] = with_fixtures(
    f"SELECT * FROM ({_scoped('w0')} UNION ALL {_scoped('w1')})", "fx_scenarios", "fx_scoped_queries"
)

# --- relevance evaluation ---

_HITS = f"""hits AS (SELECT workspace_id, strategy_id, scenario_id, 'documents' AS idx, doc_id, score, rank FROM (
      SELECT workspace_id, strategy_id, lang AS scenario_id, doc_id, score,
        row_number() OVER (PARTITION BY workspace_id, strategy_id, lang ORDER BY score DESC, doc_id) AS rank FROM (
          SELECT workspace_id, 'longest' AS strategy_id, lang, doc_id, CAST(n_chars AS DOUBLE) AS score FROM fx_judged_docs
          UNION ALL SELECT workspace_id, 'oldest', lang, doc_id, CAST(-doc_id AS DOUBLE) FROM fx_judged_docs)) WHERE rank <= {K})"""
def _metrics(judgements: str) -> str:
    return f"""rated AS (SELECT h.*, j.rating, coalesce(j.rating, 0) AS g FROM hits h
      LEFT JOIN {judgements} j USING (workspace_id, scenario_id, idx, doc_id)),
    total AS (SELECT workspace_id, scenario_id, count(*) FILTER (WHERE rating >= 1) AS total FROM {judgements} GROUP BY ALL),
    ideal AS (SELECT workspace_id, scenario_id, sum((power(2, rating) - 1) / log2(r + 1)) AS ideal FROM (
      SELECT workspace_id, scenario_id, rating,
        row_number() OVER (PARTITION BY workspace_id, scenario_id ORDER BY rating DESC) AS r FROM {judgements})
      WHERE r <= {K} GROUP BY workspace_id, scenario_id),
    stops AS (SELECT workspace_id, strategy_id, scenario_id, rank, (power(2, g) - 1) / power(2, {MAX_RATING}) AS stop FROM rated),
    errs AS (SELECT a.workspace_id, a.strategy_id, a.scenario_id, a.rank,
        any_value(a.stop) / a.rank * coalesce(product(1 - b.stop), 1) AS share
      FROM stops a LEFT JOIN stops b ON b.workspace_id = a.workspace_id AND b.strategy_id = a.strategy_id
        AND b.scenario_id = a.scenario_id AND b.rank < a.rank
      GROUP BY a.workspace_id, a.strategy_id, a.scenario_id, a.rank),
    err AS (SELECT workspace_id, strategy_id, scenario_id, sum(share) AS err FROM errs GROUP BY 1, 2, 3),
    m AS (SELECT workspace_id, strategy_id, scenario_id, avg(CASE WHEN g >= 1 THEN 1.0 ELSE 0.0 END) AS precision,
        coalesce(count(*) FILTER (WHERE g >= 1) / nullif(any_value(total), 0), 0) AS recall,
        coalesce(1.0 / min(rank) FILTER (WHERE g >= 1), 0) AS mrr, sum((power(2, g) - 1) / log2(rank + 1)) AS dcg,
        coalesce(sum((power(2, g) - 1) / log2(rank + 1)) / nullif(any_value(ideal), 0), 0) AS ndcg, any_value(err) AS err
      FROM rated LEFT JOIN total USING (workspace_id, scenario_id) LEFT JOIN ideal USING (workspace_id, scenario_id)
        JOIN err USING (workspace_id, strategy_id, scenario_id)
      GROUP BY workspace_id, strategy_id, scenario_id)"""


def _eval(body: str) -> str:
    return with_fixtures(f"WITH {_HITS}, {_metrics('fx_judgements')} {body}", "fx_judgements", "fx_judged_docs")


ORACLES["ranked_hits"] = _eval("SELECT workspace_id, strategy_id, scenario_id, idx, doc_id, score, rank FROM hits")
ORACLES["hits_left_judgements"] = _eval("SELECT workspace_id, strategy_id, scenario_id, doc_id, rank, rating FROM rated")
ORACLES["unrated_hits"] = _eval("SELECT workspace_id, strategy_id, scenario_id, doc_id, rank FROM rated WHERE rating IS NULL")
_UNRATED = """SELECT workspace_id, idx, doc_id, count(*) AS count, count(DISTINCT strategy_id) AS strategies,
      count(DISTINCT scenario_id) AS scenarios
    FROM rated WHERE rating IS NULL GROUP BY workspace_id, idx, doc_id"""
ORACLES["unrated_docs"] = _eval(_UNRATED)
for _metric in ("precision", "recall", "mrr", "dcg", "ndcg", "err"):
    ORACLES[f"{_metric}_at_k"] = _eval(f"SELECT workspace_id, strategy_id, scenario_id, round({_metric}, 6) AS {_metric} FROM m")
_ROUNDED = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(mrr, 6) AS mrr, round(dcg, 6) AS dcg, round(ndcg, 6) AS ndcg, round(err, 6) AS err"
ORACLES["evaluation_metrics"] = _eval(f"SELECT workspace_id, strategy_id, scenario_id, {_ROUNDED} FROM m")
_MEANS = ", ".join(f"round(avg({m}), 6) AS {m}" for m in ("precision", "recall", "mrr", "dcg", "ndcg", "err"))
ORACLES["evaluation_summary"] = _eval(
    f"SELECT workspace_id, strategy_id, count(*) AS searches, {_MEANS} FROM m GROUP BY GROUPING SETS ((workspace_id, strategy_id), (workspace_id))"
)
_ITEM = "CAST(item_id AS VARCHAR)"
_BOTH = f"""hits AS (
    SELECT 'w0' AS workspace_id, 'plain' AS strategy_id, query_id AS scenario_id, 'documents' AS idx, doc_id, score, rank
      FROM (WITH {_bm25('documents', 'benchmark', 'doc_id', LETTERS, query=_ITEM)})
    UNION ALL SELECT 'w0', 'without_stop_words', query_id, 'documents', doc_id, score, rank
      FROM (WITH {_bm25('documents', 'benchmark', 'doc_id', LETTERS, an.ENGLISH_STOP_WORDS, _ITEM)}))"""
_RUN = f"WITH {_BOTH}, {_metrics('fx_item_judgements')}"
ORACLES["evaluation_run"] = with_fixtures(
    f"{_RUN} SELECT workspace_id, strategy_id, scenario_id, {_ROUNDED} FROM m", "fx_item_judgements"
)
ORACLES["evaluation_run_unrated"] = with_fixtures(f"{_RUN} {_UNRATED}", "fx_item_judgements")
_JOBS = f"""plain AS (SELECT * FROM (WITH {_bm25('documents', 'benchmark', 'doc_id', LETTERS, query=_ITEM)})),
    stopped AS (SELECT * FROM (WITH {_bm25('documents', 'benchmark', 'doc_id', LETTERS, an.ENGLISH_STOP_WORDS, _ITEM)})),
    hits AS (SELECT workspace_id, strategy_id, query_id AS scenario_id, 'documents' AS idx, doc_id, score, rank
      FROM fx_search_strategies JOIN (SELECT 'simple' AS analyzer, * FROM plain UNION ALL SELECT 'stop', * FROM stopped) USING (analyzer)
      WHERE params = 'text')"""
ORACLES["evaluation_job"] = with_fixtures(
    f"""WITH {_JOBS}, {_metrics('fx_item_judgements')},
      lists AS (SELECT workspace_id, strategy_id, scenario_id,
        string_agg(concat(doc_id, ':', coalesce(CAST(rating AS VARCHAR), '-')), ',' ORDER BY rank) AS hits FROM rated GROUP BY 1, 2, 3)
    SELECT workspace_id, strategy_id, scenario_id, {_ROUNDED}, hits FROM m JOIN lists USING (workspace_id, strategy_id, scenario_id)""",
    "fx_item_judgements",
    "fx_search_strategies",
)
_JID = "sha256(concat({}))".format(
    ", ".join(
        f"coalesce(concat(length({c}), ':', {c}), '-')" for c in ("workspace_id", "scenario_id", "idx", "CAST(doc_id AS VARCHAR)")
    )
)
_SET = f"""stored AS (SELECT {_JID} AS _id, * FROM fx_judgements),
    fresh AS (SELECT {_JID} AS _id, *, CASE WHEN n_chars > 1000 THEN 3 ELSE 1 END AS new_rating,
        CASE WHEN n_chars > 1000 THEN 3 ELSE 2 END AS seq
      FROM (SELECT 'w0' AS workspace_id, lang AS scenario_id, 'documents' AS idx, doc_id, n_chars FROM documents))"""
ORACLES["set_judgement"] = with_fixtures(
    f"""WITH {_SET} SELECT coalesce(f._id, s._id) AS _id, coalesce(f.scenario_id, s.scenario_id) AS scenario_id,
      coalesce(f.doc_id, s.doc_id) AS doc_id, coalesce(f.new_rating, s.rating) AS rating
    FROM stored s FULL JOIN fresh f ON f._id = s._id""",
    "fx_judgements",
)
ORACLES["stamp_meta"] = with_fixtures(
    f"""WITH {_SET} SELECT coalesce(f._id, s._id) AS _id, CASE WHEN s._id IS NULL THEN seq ELSE 1 END AS created_at,
      CASE WHEN s._id IS NULL THEN 'bob' ELSE 'ann' END AS created_by, 'server' AS created_via,
      CASE WHEN s._id IS NOT NULL THEN seq END AS updated_at,
      CASE WHEN s._id IS NOT NULL AND f._id IS NOT NULL THEN 'bob' END AS updated_by,
      CASE WHEN s._id IS NOT NULL AND f._id IS NOT NULL THEN 'server' END AS updated_via
    FROM stored s FULL JOIN fresh f ON f._id = s._id""",
    "fx_judgements",
)
ORACLES["unset_judgement"] = with_fixtures(
    f"""SELECT {_JID} AS _id, doc_id, rating FROM fx_judgements
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "fx_judgements",
)
ORACLES["validate_workspace"] = """
    WITH r AS (SELECT concat(conv_id, '-', turn) AS record_id, CASE WHEN role <> 'system' THEN concat('w', conv_id % 2) END AS ws,
        CASE WHEN length(text) > 300 THEN NULL ELSE CAST(length(text) AS INTEGER) END AS scale FROM conversations),
      p AS (SELECT *, CASE WHEN ws <> 'w0' THEN 'record of another workspace'
        WHEN scale IS NULL THEN 'scale_max cannot be read as an integer' ELSE '' END AS problem FROM r)
    SELECT record_id, CASE WHEN problem = '' THEN coalesce(ws, 'w0') ELSE ws END AS workspace_id,
      CASE WHEN problem = '' THEN 0 END AS scale_min, CASE WHEN problem = '' THEN scale END AS scale_max, problem FROM p"""
ORACLES["read_records"] = with_fixtures(
    """SELECT scenario_id AS _id, workspace_id, replace(params, ',', '|') AS params, replace(tags, ',', '|') AS tags, text,
      'ann' AS created_by, turn AS note, CAST(1 AS BIGINT) AS extras FROM fx_scenarios""",
    "fx_scenarios",
)
_PAIRS = """c AS (SELECT sc.workspace_id, strategy_id, scenario_id, sc.text, sc.turn, st.source, sc.tags AS sc_tags, st.tags AS st_tags
    FROM fx_scenarios sc JOIN fx_strategies st ON st.workspace_id = sc.workspace_id
      AND list_has_all(coalesce(string_split(sc.params, ','), []), coalesce(string_split(st.params, ','), [])))"""
ORACLES["select_candidates"] = with_fixtures(
    f"""WITH {_PAIRS} SELECT workspace_id, strategy_id, scenario_id FROM c
    WHERE list_has_any(string_split(sc_tags, ','), ['long', 'system'])
      AND (strategy_id = 'Brand#1' OR list_has_any(string_split(st_tags, ','), ['exp']))""",
    "fx_scenarios",
    "fx_strategies",
)
ORACLES["sample_scenarios"] = with_fixtures(
    "SELECT scenario_id, workspace_id FROM fx_scenarios ORDER BY md5(concat('7|', scenario_id)), scenario_id LIMIT 25",
    "fx_scenarios",
)
ORACLES["render_strategy"] = with_fixtures(
    f"""WITH {_PAIRS} SELECT workspace_id, strategy_id, scenario_id,
      replace(replace(source, '{{{{turn}}}}', turn), '{{{{text}}}}', text) AS rendered FROM c""",
    "fx_scenarios",
    "fx_strategies",
)
ORACLES["latest_evaluations"] = """
    SELECT event_id AS evaluation_id, event_type AS benchmark_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT 100"""
ORACLES["flatten_conversations"] = """
    WITH r AS (SELECT conv_id, turn, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS round_no
        FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations WHERE role <> 'system')),
      r2 AS (SELECT conv_id, turn, round_no, list_filter(string_split(line, '. '), lambda s: len(string_split(s, ' ')) > 2) AS ss FROM r),
      s AS (SELECT conv_id, turn, round_no, unnest(ss) AS sentence, generate_subscripts(ss, 1) - 1 AS step_no FROM r2),
      w AS (SELECT conv_id, turn, round_no, step_no, unnest(string_split(sentence, ' ')) AS result,
        generate_subscripts(string_split(sentence, ' '), 1) - 1 AS result_no FROM s)
    SELECT conv_id, turn, round_no, 'done' AS status, step_no, 'sentence' AS type, result_no, result FROM w
    UNION ALL SELECT conv_id, turn, round_no, 'done', NULL, NULL, NULL, NULL FROM r2 WHERE len(ss) = 0
    UNION ALL SELECT conv_id, turn, NULL, NULL, NULL, NULL, NULL, NULL FROM conversations WHERE role = 'system'"""
ORACLES["model_usage"] = with_fixtures(
    """SELECT inference_id, CAST(sum(llm_calls) AS BIGINT) AS llm_calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
      CAST(sum(output_tokens) AS BIGINT) AS output_tokens, round(avg(time_to_first_token), 6) AS avg_time_to_first_token,
      max(time_to_last_token) AS max_time_to_last_token FROM fx_rounds GROUP BY inference_id""",
    "fx_rounds",
)

_SIGN = "CASE WHEN substr(digits, 1, 1) < '8' THEN 1 ELSE -1 END"
_WEIGHT = "(" + " + ".join(f"CASE WHEN substr(digits, 2, {comparison.DIGITS}) >= '{limit}' THEN 1 ELSE 0 END" for limit in comparison.poisson_limits()) + ")"
_LONG = " UNION ALL ".join(
    f"SELECT workspace_id, strategy_id, scenario_id, '{m}' AS metric, CAST({m} AS DECIMAL(20, 9)) AS value FROM m"
    for m in ("precision", "recall", "mrr", "dcg", "ndcg", "err")
)
ORACLES["compare_strategies"] = with_fixtures(
    f"""{_RUN}, long AS ({_LONG}),
      pairs AS (SELECT a.workspace_id, a.strategy_id AS strategy_a, b.strategy_id AS strategy_b, metric, scenario_id, b.value - a.value AS d
        FROM long a JOIN long b USING (workspace_id, scenario_id, metric) WHERE a.strategy_id < b.strategy_id),
      whole AS (SELECT workspace_id, strategy_a, strategy_b, metric, count(*) AS scenarios, sum(d) AS total FROM pairs GROUP BY ALL),
      drawn AS (SELECT *, md5(concat_ws('|', '0', workspace_id, scenario_id, CAST(r AS VARCHAR))) AS digits
        FROM pairs, (SELECT unnest(range(1, {comparison.ROUNDS + 1})) AS r)),
      rounds AS (SELECT workspace_id, strategy_a, strategy_b, metric, r, sum(d * {_SIGN}) AS turned,
          CASE WHEN sum({_WEIGHT}) > 0 THEN CAST(sum(d * {_WEIGHT}) AS DOUBLE) / sum({_WEIGHT}) ELSE 0 END AS mean FROM drawn GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY workspace_id, strategy_a, strategy_b, metric ORDER BY mean) AS place
        FROM rounds JOIN whole USING (workspace_id, strategy_a, strategy_b, metric))
    SELECT workspace_id, strategy_a, strategy_b, metric, any_value(scenarios) AS scenarios,
      round(CAST(any_value(total) AS DOUBLE) / any_value(scenarios), 6) AS difference,
      round((count(*) FILTER (abs(turned) >= abs(total)) + 1) / {comparison.ROUNDS + 1}, 6) AS p_value,
      round(max(mean) FILTER (place = {int(comparison.ROUNDS * comparison.OUTSIDE / 2) + 1}), 6) AS low,
      round(max(mean) FILTER (place = {comparison.ROUNDS - int(comparison.ROUNDS * comparison.OUTSIDE / 2)}), 6) AS high
    FROM ranked GROUP BY workspace_id, strategy_a, strategy_b, metric""",
    "fx_item_judgements",
)
ORACLES["ratings_as_of"] = with_fixtures(
    """SELECT evaluation_id, strategy_id, h.scenario_id, h.doc_id, arg_max(struct_pack(r := rating), (rated_at, seq)).r AS rating
    FROM fx_timed_hits h LEFT JOIN fx_rating_history y ON y.workspace_id = h.workspace_id AND y.scenario_id = h.scenario_id
      AND y.idx = h.idx AND y.doc_id = h.doc_id AND rated_at <= created_at
    GROUP BY evaluation_id, strategy_id, h.scenario_id, h.doc_id""",
    "fx_timed_hits",
    "fx_rating_history",
)
_SESSIONS = """e AS (SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, value FROM events),
    marked AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM marked),
    found AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
        round(CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE), 6) AS total, max(value) AS largest, min(event_id) AS first_event
      FROM numbered GROUP BY user_id, s),
    shown AS (SELECT user_id, epoch_ms(session_start) AS session_start, epoch_ms(session_end) AS session_end, events, total, largest, first_event FROM found)"""
ORACLES["usage_sessions"] = f"WITH {_SESSIONS} SELECT * FROM shown"
ORACLES["usage_sessions_stream"] = f"""WITH {_SESSIONS}
    SELECT * FROM shown WHERE session_end <= (SELECT epoch_ms(max(ts) - INTERVAL 10 MINUTE) FROM e)"""
_VERSIONS = """files AS (SELECT file, max(ts) AS latest FROM fx_event_files GROUP BY file),
    bounded AS (SELECT f.*, (SELECT max(latest) - INTERVAL 3 DAY FROM files WHERE files.file < f.file) AS bound FROM fx_event_files f),
    timely AS (SELECT * FROM bounded WHERE bound IS NULL OR ts >= bound),
    known AS (SELECT t.event_id, t.user_id, t.file, t.ts, (SELECT max((p.ts, p.event_id)) FROM timely p WHERE p.user_id = t.user_id AND p.file < t.file) AS held,
        max((ts, event_id)) OVER (PARTITION BY user_id, file) AS newest FROM timely t),
    judged AS (SELECT event_id, user_id, file AS n, CASE WHEN (ts, event_id) = held THEN 'repeated' WHEN (ts, event_id) < held OR (ts, event_id) < newest THEN 'overtaken'
        ELSE 'newest' END AS fate, ts FROM known
      UNION ALL SELECT event_id, user_id, file, 'late', ts FROM bounded WHERE ts < bound)"""
ORACLES["stream_versions"] = with_fixtures(f"WITH {_VERSIONS} SELECT event_id, user_id, n, fate FROM judged", "fx_event_files")
ORACLES["stream_newest"] = with_fixtures(
    f"WITH {_VERSIONS} SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM judged WHERE fate <> 'late' GROUP BY user_id", "fx_event_files"
)
ORACLES["search_after_upserts"] = with_fixtures(
    f"""WITH corpus AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM fx_corrected)
        AND doc_id NOT IN (SELECT doc_id FROM fx_withdrawn)
      UNION ALL SELECT * FROM fx_corrected UNION ALL SELECT * FROM fx_added),
    """
    + _bm25("corpus", "fx_queries", "doc_id", LETTERS),
    "fx_corrected",
    "fx_withdrawn",
    "fx_added",
    "fx_queries",
)
ORACLES["sketch_facets"] = " UNION ALL ".join(
    f"""SELECT {a} AS l_returnflag, {b} AS l_linestatus, count(*) AS rows, count(DISTINCT l_suppkey) AS n_values,
      least({K}, count(DISTINCT l_suppkey)) AS shown, true AS within_bounds FROM lineitem GROUP BY ALL"""
    for a, b in (("l_returnflag", "l_linestatus"), ("l_returnflag", "CAST(NULL AS VARCHAR)"), ("CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"))
)
