"""Input tables of the registered queries, derived from the given tables.

One definition in common SQL serves both engines; every table holds whole texts of whole
tables and grows with them. The given tables hold no markup, categories or records, so these
statements wrap them in some.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

#: Letters and what they become in the Japanese variant of a text.
LATIN = "abcdefghijklmnopqrstuvwxyz"
JAPANESE = "日本語のアカガーイｶﾞラ東京都はをリストウヴワ国ヤズ"

FIXTURES = {
    # Articles: wikitext around each document; short documents stand for redirects.
    "fx_pages": """
        SELECT doc_id AS page_id, n_chars < 200 AS redirect, 0 AS ns,
          concat(source, ' doc/', CAST(doc_id AS STRING)) AS title,
          concat('<!-- c', chr(10), ' -->', chr(10), '== ', lang, ' ==', chr(10), '{{box|{{in|', source, '}}}}',
            '''''''', text, '''''''', ' [[', source, '|label]] [[', lang, ']] <ref name="a">r</ref>',
            ' <ref name="b"/> swallowed <ref>r</ref> [http://x.example/', source, ' link]',
            ' [[File:', source, '.png|thumb]] [[Category:', source, '|', lang, ']] [[カテゴリ:', source, '_', lang, ']]',
            CASE WHEN n_chars > 1000 THEN concat('[[Category:', lang, ']]') ELSE '' END,
            ' a &amp; b &lt;c&gt; <ref name="c" /> <br>') AS text
        FROM documents""",
    # Category pages: many pages share a title, some are empty.
    "fx_category_pages": """
        SELECT 1000000000 + doc_id AS page_id, false AS redirect, 14 AS ns, concat('Category:', source) AS title,
          CASE WHEN n_chars < 200 THEN ''
            ELSE concat('[[Category:', lang, '|k]] [[カテゴリ:grp_', CAST(n_chars % 3 AS STRING), ']] ', text) END AS text
        FROM documents
        UNION ALL
        SELECT 2000000000 + doc_id, false, 14, concat('Category:', source, '_', lang), concat('[[Category:', source, ']]')
        FROM documents
        UNION ALL
        SELECT 3000000000 + doc_id, false, 14, concat('Category:', lang), '[[Category:root]]' FROM documents""",
    # Ordered substring rules: 'src1' also hits src10..src19, 'doc/9' matches titles only.
    "fx_rules": """
        SELECT * FROM (VALUES (0,'A','a1','src1'),(0,'A','a1','src2'),(1,'A','a2','src5 fr'),(1,'A','a2','src5 es'),
          (2,'B','b1','src7'),(2,'B','b1','src8'),(3,'B','b2','src9 '),(4,'C','c1','doc/9')) AS t(rule_ord, l1, l2, keyword)""",
    # Articles named by the first words of their text, and very many keywords cut out of all texts.
    "fx_named": """
        SELECT doc_id AS page_id, substr(text, 1, 60) AS title, concat(source, '|', source, ' ', lang) AS direct,
          concat(source, '|', source, ' ', lang, '|', substr(text, 61, 30), '|', lang) AS everything FROM documents""",
    "fx_keywords": """
        SELECT CAST(min(doc_id % 97) AS INT) AS rule_ord, concat('L', CAST(min(doc_id % 97) % 7 AS STRING)) AS l1,
          concat('M', CAST(min(doc_id % 97) AS STRING)) AS l2, keyword
        FROM (SELECT doc_id, substr(text, o, n) AS keyword FROM documents
          JOIN (VALUES (3, 7),(11, 8),(25, 7),(60, 9),(90, 8),(120, 7),(150, 8),(200, 7),(260, 8),(320, 9)) AS t(o, n) ON length(text) > o + n) AS cut
        GROUP BY keyword""",
    # Texts with marks inside words and numbers, and words of several scripts joined by connectors.
    "fx_marked": """
        SELECT doc_id, concat(replace(replace(replace(text, 's ', '''s '), 'e ', 'e.'), 'n ', 'n:'), ' can''t ', CAST(n_chars AS STRING), '.14,5 ',
          lang, '_カタカナabc', source, ' 3.', CAST(doc_id AS STRING), ',x _', lang, '_ __ 12:30 a.1 "', source, '" カ_') AS text
        FROM documents""",
    "fx_facets": """
        SELECT p_partkey AS page_id, p_name AS title, p_type AS taxonomy_l1, p_brand AS taxonomy_l2,
          concat(p_brand, '/', CAST(p_size AS STRING)) AS taxonomy_l3 FROM part""",
    "fx_corpus": """
        SELECT doc_id AS page_id, concat(source, ' doc/', CAST(doc_id AS STRING)) AS title, text AS body,
          source AS taxonomy_l1 FROM documents""",
    # Later versions: labelled documents, twice where they are also toxic.
    "fx_delta": """
        SELECT d.doc_id AS page_id, concat('v2 ', d.source) AS title, d.text AS body, d.lang AS taxonomy_l1, 1 AS seq
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id
        UNION ALL
        SELECT d.doc_id, concat('v3 ', d.source), d.text, d.lang, 2
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1""",
    # Own documents: the web pages, plus corrections of labelled documents, twice where they are good.
    "fx_custom": """
        SELECT 900000000 + page_id AS page_id, url AS title, html AS body, 1 AS seq FROM pages
        UNION ALL
        SELECT d.doc_id, concat('own ', d.source), d.text, 1 FROM documents d JOIN labels l ON l.doc_id = d.doc_id
        UNION ALL
        SELECT d.doc_id, concat('own again ', d.source), d.text, 2
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1""",
    # Two workspaces judge the same scenarios and documents, each in its own way.
    "fx_judgements": """
        SELECT 'w0' AS workspace_id, d.lang AS scenario_id, 'documents' AS idx, l.doc_id AS doc_id,
          2 * l.quality + (1 - l.toxic) AS rating FROM labels l JOIN documents d ON d.doc_id = l.doc_id
        UNION ALL
        SELECT 'w1', d.lang, 'documents', l.doc_id, 3 * (1 - l.quality)
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.doc_id % 3 > 0""",
    "fx_judged_docs": """
        SELECT concat('w', CAST(doc_id % 2 AS STRING)) AS workspace_id, doc_id, lang, n_chars FROM documents""",
    # Ratings of documents for benchmark items.
    "fx_item_judgements": """
        SELECT 'w0' AS workspace_id, CAST(b.item_id AS STRING) AS scenario_id, 'documents' AS idx, l.doc_id AS doc_id,
          2 * l.quality + (1 - l.toxic) AS rating
        FROM (SELECT *, doc_id % (SELECT count(*) FROM benchmark) AS place FROM labels) AS l JOIN benchmark b ON b.item_id = l.place""",
    # Ratings over time: every event rates a document, errors take the rating back.
    "fx_rating_history": """
        SELECT 'w0' AS workspace_id, d.lang AS scenario_id, 'documents' AS idx, d.doc_id AS doc_id, e.ts AS rated_at, e.event_id AS seq,
          CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(floor(e.value) AS INT) % 4 END AS rating
        FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS place FROM events) AS e JOIN documents d ON d.doc_id = e.place""",
    # Hits of evaluations, at the time of each.
    "fx_timed_hits": """
        SELECT 'w0' AS workspace_id, e.event_type AS strategy_id, e.event_id AS evaluation_id, d.lang AS scenario_id, 'documents' AS idx,
          d.doc_id AS doc_id, e.ts AS created_at
        FROM (SELECT *, (7 * event_id + 3) % (SELECT count(*) FROM documents) AS place FROM events) AS e
        JOIN documents d ON d.doc_id = e.place""",
    # Corrected documents: good ones have their text twice.
    "fx_corrected": """
        SELECT d.doc_id AS doc_id, concat(d.text, ' ', d.text) AS text FROM documents d JOIN labels l ON l.doc_id = d.doc_id
        WHERE l.quality = 1 AND l.toxic = 0""",
    "fx_withdrawn": "SELECT doc_id FROM labels WHERE toxic = 1",
    "fx_added": "SELECT 900000000 + page_id AS doc_id, concat(url, ' ', html) AS text FROM pages",
    # Six files of events: one slice of time each, an eighth of the slice before again, and a tenth of the one three before.
    "fx_event_files": """
        SELECT event_id, ts, user_id, slice + again AS file FROM (
          SELECT event_id, date_trunc('MILLISECOND', ts) AS ts, user_id, CAST(floor(6 * event_id / (SELECT count(*) FROM events)) AS INT) AS slice FROM events) AS s
        JOIN (VALUES (0, 1, 0), (1, 8, 3), (3, 10, 1)) AS t(again, parts, part) ON event_id % parts = part AND slice + again < 6""",
    # One scenario per conversation turn; only users give the turn as a parameter, and system turns give none.
    "fx_scenarios": """
        SELECT concat('w', CAST(conv_id % 2 AS STRING)) AS workspace_id,
          concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS scenario_id,
          CASE WHEN role = 'user' THEN 'text,turn' WHEN role = 'assistant' THEN 'text' END AS params,
          CASE WHEN length(text) > 200 THEN concat(role, ',long') ELSE concat(role, ',short') END AS tags,
          text, CAST(turn AS STRING) AS turn FROM conversations""",
    # One strategy per part brand and workspace.
    "fx_strategies": """
        SELECT DISTINCT CASE WHEN p_size > 25 THEN 'w0' ELSE 'w1' END AS workspace_id, p_brand AS strategy_id,
          CASE WHEN p_brand < 'Brand#12' THEN NULL WHEN p_brand < 'Brand#2' THEN 'text' WHEN p_brand < 'Brand#4' THEN 'text,turn' ELSE 'text,turn,lang' END AS params,
          CASE WHEN p_brand < 'Brand#3' THEN 'base' ELSE 'base,exp' END AS tags,
          '{"q":"{{text}}","n":"{{turn}}","l":"{{lang}}"}' AS source FROM part""",
    "fx_rounds": """
        SELECT conv_id, turn, role, text, concat('m', CAST(conv_id % 3 AS STRING)) AS inference_id, 1 AS llm_calls,
          CASE WHEN role = 'user' THEN length(text) ELSE 0 END AS input_tokens,
          CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS output_tokens,
          turn * 10 + length(role) AS time_to_first_token, turn * 10 + length(text) AS time_to_last_token
        FROM conversations""",
    "fx_evaluations": """
        SELECT event_id AS evaluation_id, event_type AS benchmark_id, ts AS created_at FROM events""",
    "fx_ja": f"""
        SELECT doc_id, translate(lower(text), '{LATIN}', '{JAPANESE}') AS text FROM documents""",
    # Search strategies: one per region, with either analyzer.
    "fx_search_strategies": """
        SELECT 'w0' AS workspace_id, r_name AS strategy_id, CASE WHEN r_regionkey % 2 = 0 THEN 'simple' ELSE 'stop' END AS analyzer,
          CASE WHEN r_regionkey = 4 THEN 'text,turn' ELSE 'text' END AS params, '{"q":"{{text}}"}' AS source FROM region""",
    "fx_queries": "SELECT item_id AS query_id, text FROM benchmark",
    "fx_scoped_queries": """
        SELECT concat('w', CAST(item_id % 2 AS STRING)) AS workspace_id, item_id AS query_id, text FROM benchmark""",
}


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table on Spark."""
    statement = FIXTURES[name]
    frames = {}
    for table in TABLES:
        used = re.compile(rf"\b(FROM|JOIN) {table}\b")
        if used.search(statement):
            view = f"corpusloom_{table}"
            tables(spark, sf_dir, table).createOrReplaceTempView(view)
            statement = used.sub(rf"\1 {view}", statement)
    return spark.sql(statement)


def with_fixtures(query: str, *names: str) -> str:
    """An oracle query with the derived tables it reads as common table expressions."""
    parts = ", ".join(f"{name} AS ({FIXTURES[name]})" for name in names)
    body = query.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"
