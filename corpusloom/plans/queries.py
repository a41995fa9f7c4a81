"""Registered queries: one per operator, each over whole tables.

Lists are joined to text and dates rendered, so that any engine's result can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions import analysis as an
from corpusloom.functions import text as tx
from corpusloom.operators import (
    collocations,
    comparison,
    facets,
    filters,
    hierarchy,
    relevance,
    search,
    segmentation,
    segments,
    sketches,
    taxonomy,
    tokens,
)
from corpusloom.operators.history import as_of
from corpusloom.plans.corpus import article_categories, build_articles, classify
from corpusloom.plans.evaluation import run_benchmark, run_evaluation, search_hits
from corpusloom.plans.fixtures import fixture, tables
from corpusloom.session import fresh_path, materialize
from corpusloom.sources import dump, ndjson, packing, publish, records
from corpusloom.streaming import ingest, sessions, versions

NOW = "2026-04-02 10:30:15"
SEP = "|"
K = 10
MAX_RATING = 3

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


def joined(*names: str) -> list[Column]:
    return [F.array_join(n, SEP).alias(n) for n in names]


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


# --- text functions ------------------------------------------------------------------------

TEXT_STEPS = {
    "strip_comments": tx.strip_comments,
    "strip_paired_refs": tx.strip_paired_refs,
    "strip_selfclosing_refs": tx.strip_selfclosing_refs,
    "strip_tags": tx.strip_tags,
    "strip_templates": tx.strip_templates,
    "strip_media_category_links": tx.strip_media_category_links,
    "unwrap_external_links": tx.unwrap_external_links,
    "unwrap_piped_links": tx.unwrap_piped_links,
    "unwrap_links": tx.unwrap_links,
    "unwrap_headings": tx.unwrap_headings,
    "strip_emphasis": tx.strip_emphasis,
    "collapse_ws": tx.collapse_ws,
    "truncate_body": tx.truncate_body,
}


def _text_step(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: fixture(spark, sf, "fx_pages").select("page_id", step(F.col("text")).alias("text"))


for _name, _step in TEXT_STEPS.items():
    QUERIES[_name] = _text_step(_step)


@register("html_unescape")
def _(spark, sf):
    return tables(spark, sf, "pages").select("page_id", tx.html_unescape(F.col("html")).alias("html"))


@register("strip_wikitext")
def _(spark, sf):
    return tx.strip_wikitext(fixture(spark, sf, "fx_pages"), "text", "body").select("page_id", "body")


@register("strip_wikitext_html")
def _(spark, sf):
    return tx.strip_wikitext(tables(spark, sf, "pages"), "html", "body").select("page_id", "body")


@register("wiki_url")
def _(spark, sf):
    return tables(spark, sf, "pages").select("page_id", tx.wiki_url(F.col("url")).alias("url"))


@register("normalize_category")
def _(spark, sf):
    return tables(spark, sf, "documents").select("doc_id", tx.normalize_category(F.col("text")).alias("name"))


@register("category_from_title")
def _(spark, sf):
    return fixture(spark, sf, "fx_category_pages").select("page_id", tx.category_from_title(F.col("title")).alias("name"))


@register("extract_categories")
def _(spark, sf):
    names = fixture(spark, sf, "fx_pages").select("page_id", tx.extract_categories(F.col("text")).alias("names"))
    return names.select("page_id", *joined("names"))


@register("dedupe_keep_order")
def _(spark, sf):
    words = tables(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return words.select("doc_id", tx.dedupe_keep_order(F.col("words")).alias("words")).select("doc_id", *joined("words"))


# --- filters -------------------------------------------------------------------------------


@register("filter_articles")
def _(spark, sf):
    return filters.filter_articles(fixture(spark, sf, "fx_pages")).select("page_id", "title", "body")


@register("filter_category_pages")
def _(spark, sf):
    return filters.filter_category_pages(fixture(spark, sf, "fx_category_pages")).select(
        "page_id", "category", *joined("parents")
    )


@register("limit_rows")
def _(spark, sf):
    return filters.limit_rows(fixture(spark, sf, "fx_corpus").select("page_id", "title"), 100)


@register("keyset_page")
def _(spark, sf):
    return filters.keyset_page(fixture(spark, sf, "fx_corpus").select("page_id", "title"), 99, 50)


@register("term_filter")
def _(spark, sf):
    return filters.term_filter(fixture(spark, sf, "fx_corpus"), "taxonomy_l1", "src7").select("page_id", "title")


@register("term_filter_multi")
def _(spark, sf):
    found = filters.term_filter_multi(_hierarchy(spark, sf), "categories_all", "root")
    return found.agg(F.count(F.lit(1)).alias("count"))


@register("source_includes")
def _(spark, sf):
    return filters.source_includes(fixture(spark, sf, "fx_corpus"), ["page_id", "title", "taxonomy_l1"])


# --- hierarchy and taxonomy ----------------------------------------------------------------


def _edges(spark, sf) -> DataFrame:
    return hierarchy.category_edges(fixture(spark, sf, "fx_category_pages"))


def _articles(spark, sf) -> DataFrame:
    return article_categories(fixture(spark, sf, "fx_pages"))


def _hierarchy(spark, sf) -> DataFrame:
    return hierarchy.resolve_hierarchy(_articles(spark, sf), _edges(spark, sf))


def _classified(spark, sf) -> DataFrame:
    return classify(_articles(spark, sf), _edges(spark, sf), fixture(spark, sf, "fx_rules"))


@register("category_edges")
def _(spark, sf):
    return _edges(spark, sf)


@register("parents_level1")
def _(spark, sf):
    return _hierarchy(spark, sf).select("page_id", *joined("categories_level1"))


@register("parents_level2")
def _(spark, sf):
    return _hierarchy(spark, sf).select("page_id", *joined("categories_level2"))


@register("categories_all")
def _(spark, sf):
    return _hierarchy(spark, sf).select("page_id", *joined("categories_all"))


@register("resolve_hierarchy")
def _(spark, sf):
    return _hierarchy(spark, sf).select(
        "page_id", *joined("categories_direct", "categories_level1", "categories_level2", "categories_all")
    )


@register("classify_taxonomy")
def _(spark, sf):
    return _classified(spark, sf).select("page_id", "taxonomy_l1", "taxonomy_l2", "taxonomy_l3")


@register("classify_by_index")
def _(spark, sf):
    found = taxonomy.classify_by_index(
        hierarchy.resolve_hierarchy(_articles(spark, sf), _edges(spark, sf), carry=("title",)), fixture(spark, sf, "fx_rules")
    )
    return found.select("page_id", "taxonomy_l1", "taxonomy_l2", "taxonomy_l3")


@register("classify_many_keywords")
def _(spark, sf):
    named = fixture(spark, sf, "fx_named")
    articles = named.select("page_id", "title", *(F.split(c, r"\|").alias(f"categories_{n}") for c, n in (("direct", "direct"), ("everything", "all"))))
    return taxonomy.classify_by_index(articles, fixture(spark, sf, "fx_keywords")).select("page_id", "taxonomy_l1", "taxonomy_l2", "taxonomy_l3")


@register("category_coverage")
def _(spark, sf):
    pages = fixture(spark, sf, "fx_pages").unionByName(fixture(spark, sf, "fx_category_pages"))
    return hierarchy.category_coverage(pages)


@register("build_articles")
def _(spark, sf):
    pages = fixture(spark, sf, "fx_pages").unionByName(fixture(spark, sf, "fx_category_pages"))
    table = build_articles(pages, fixture(spark, sf, "fx_rules"), now())
    return table.select("page_id", "title", "body", "url", *joined("categories_all"), "taxonomy_l1", "taxonomy_l2", "taxonomy_l3")


# --- facets --------------------------------------------------------------------------------


@register("terms_l1")
def _(spark, sf):
    return facets.terms(fixture(spark, sf, "fx_facets"), "taxonomy_l1", 20)


@register("terms_l2")
def _(spark, sf):
    return facets.terms(fixture(spark, sf, "fx_facets"), "taxonomy_l2", 30)


@register("terms_l3")
def _(spark, sf):
    return facets.terms(fixture(spark, sf, "fx_facets"), "taxonomy_l3", 30)


LEVELS = ["taxonomy_l1", "taxonomy_l2", "taxonomy_l3"]


@register("drilldown_3level")
def _(spark, sf):
    return facets.drilldown(fixture(spark, sf, "fx_facets"), LEVELS, [15, 10, 10])


@register("drilldown_articles")
def _(spark, sf):
    """Pages to taxonomy to drill-down: the flagship."""
    return facets.drilldown(_classified(spark, sf), LEVELS, [15, 10, 10])


@register("count_in_category")
def _(spark, sf):
    return facets.count_in_category(_hierarchy(spark, sf), "en")


@register("top_hits_per_bucket")
def _(spark, sf):
    source = ["page_id", "title", *LEVELS]
    return facets.top_hits(fixture(spark, sf, "fx_facets"), "taxonomy_l1", 12, 3, source)


@register("filtered_multi_terms")
def _(spark, sf):
    return facets.filtered_terms(_classified(spark, sf), "taxonomy_l1", "A", "categories_direct", 30)


@register("level_facets")
def _(spark, sf):
    return facets.filtered_terms(_classified(spark, sf), "taxonomy_l1", "A", "categories_level1", 30)


@register("level2_facets")
def _(spark, sf):
    return facets.filtered_terms(_classified(spark, sf), "taxonomy_l1", "B", "categories_level2", 30)


@register("breakdown_l1_l2_l3")
def _(spark, sf):
    return facets.breakdown(fixture(spark, sf, "fx_facets"), LEVELS)


@register("terms_other_count")
def _(spark, sf):
    return facets.terms_other_count(fixture(spark, sf, "fx_facets"), "taxonomy_l3", 30)


def _listed(spark, sf, name: str) -> DataFrame:
    df = fixture(spark, sf, name)
    return df.withColumns({c: F.split(c, ",") for c in ("params", "tags")})


@register("distinct_tags")
def _(spark, sf):
    return facets.distinct_tags(_listed(spark, sf, "fx_scenarios"), "w0", 100)


# --- sources and sinks ---------------------------------------------------------------------


@register("scan_dump")
def _(spark, sf):
    pages = fixture(spark, sf, "fx_pages").unionByName(fixture(spark, sf, "fx_category_pages"))
    path = fresh_path(spark, "dump")
    dump.write_dump(pages, path)
    return dump.scan_dump(spark, path)


def _custom_lines(spark, sf) -> str:
    """Web pages as JSON lines; pages of some site lack a body, every line of another is cut off."""
    path = fresh_path(spark, "custom")
    doc = F.to_json(
        F.struct(
            F.col("page_id"),
            F.col("url").alias("title"),
            F.when(~F.col("url").contains("example.net"), F.col("html")).alias("body"),
        )
    )
    cut_off = F.concat(F.lit('{"page_id": '), F.col("page_id").cast("string"), F.lit(","))
    line = F.when(F.col("url").contains("example.org"), cut_off).otherwise(doc)
    tables(spark, sf, "pages").select(line.alias("value")).write.text(path)
    return path


@register("read_custom_docs")
def _(spark, sf):
    accepted, _ = ndjson.read_custom_docs(spark, _custom_lines(spark, sf), now())
    return accepted.select("page_id", "title", "body", "url", F.date_format("fetched_at", records.ISO_SECONDS).alias("fetched_at"))


@register("reject_custom_docs")
def _(spark, sf):
    _, rejected = ndjson.read_custom_docs(spark, _custom_lines(spark, sf), now())
    return rejected.select(F.col("_corrupt").isNotNull().alias("unreadable")).groupBy("unreadable").agg(F.count(F.lit(1)).alias("n"))


def _docs(spark, sf) -> DataFrame:
    """Documents of the corpus, all twelve fields."""
    rows = records.apply_schema_contract(fixture(spark, sf, "fx_corpus"))
    return records.rows_to_docs(rows, now())


def _exported(spark, sf) -> str:
    path = fresh_path(spark, "bulk")
    docs = _docs(spark, sf)
    size = "_bytes"
    sized = docs.withColumn(size, F.octet_length(ndjson.bulk_lines(docs)) + 1)
    ndjson.write_bulk_ndjson(packing.with_part_no(sized, size, cap=256 * 1024).drop(size), path)
    return path


@register("write_bulk_ndjson")
def _(spark, sf):
    """Exported lines, read back as plain text."""
    lines = spark.read.text(_exported(spark, sf))
    is_action = F.startswith("value", F.lit(ndjson.ACTION_START))
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_action).alias("actions"),
        F.count_if(F.get_json_object("value", "$.page_id").isNotNull()).alias("docs"),
        F.sum(F.char_length(F.get_json_object("value", "$.body"))).alias("body_chars"),
    )


@register("read_bulk_ndjson")
def _(spark, sf):
    docs, _ = ndjson.read_bulk_ndjson(spark, _exported(spark, sf) + "/*", framed=True)
    return docs.select("_id", "page_id", "title", "body", "fetched_at", "taxonomy_l1")


@register("read_bulk_ndjson_by_line")
def _(spark, sf):
    docs, _ = ndjson.read_bulk_ndjson(spark, _exported(spark, sf) + "/*")
    return docs.select("_id", "page_id", "title", "body", "fetched_at", "taxonomy_l1")


@register("read_pages_table")
def _(spark, sf):
    path = fresh_path(spark, "pages")
    records.apply_schema_contract(fixture(spark, sf, "fx_corpus")).write.parquet(path)
    return records.read_pages_table(spark, path, after=-1, ordered=True).select("page_id", "title", "taxonomy_l1")


@register("pack_by_bytes")
def _(spark, sf):
    rows = fixture(spark, sf, "fx_corpus").select("page_id", F.octet_length("body").alias("bytes"))
    return packing.pack_by_bytes(rows, "bytes", cap=20_000, bucket_keys=300)


@register("reject_bulk_ndjson")
def _(spark, sf):
    """Bulk files with broken documents, spaced actions, no ids and documents that begin like actions."""
    path = fresh_path(spark, "damaged")
    action = F.concat(
        F.when(F.col("page_id") % 5 == 1, F.lit('{ "index" : {"_id": "')).otherwise(F.lit('{"index":{"_id":"')),
        F.when(F.col("page_id") % 5 == 2, F.lit("")).otherwise(F.col("page_id").cast("string")),
        F.lit('"}}'),
    )
    doc = F.when(F.col("page_id") % 5 == 3, F.lit('{"index":1,"page_id":')).otherwise(
        F.to_json(F.struct(F.lit("first").alias("index"), "page_id", "title", "body"))
    )
    pairs = fixture(spark, sf, "fx_corpus").select(F.concat(action, F.lit("\n"), doc).alias("value"))
    pairs.write.text(path)
    docs, rejected = ndjson.read_bulk_ndjson(spark, path, strict=False)
    kept = docs.select(F.lit("").alias("problem"), F.char_length("body").alias("chars"))
    refused = rejected.select("problem", F.lit(0).alias("chars"))
    return kept.unionByName(refused).groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


@register("pack_requests")
def _(spark, sf):
    """Requests inside the files of an export, both with small caps."""
    rows = fixture(spark, sf, "fx_corpus").select("page_id", F.octet_length("body").alias("bytes"))
    filed = packing.with_part_no(rows, "bytes", cap=60_000, bucket_keys=300)
    return packing.pack_requests(filed, "bytes", cap=9_000, bucket_keys=300).select("page_id", "part_no", "request")


@register("pack_requests_uncapped")
def _(spark, sf):
    """Requests of an export without files: packed by buckets of keys."""
    rows = fixture(spark, sf, "fx_corpus").select("page_id", F.octet_length("body").alias("bytes"))
    filed = packing.with_part_no(rows, "bytes", cap=0)
    return packing.pack_requests(filed, "bytes", cap=9_000, bucket_keys=300).select("page_id", "bucket", "request")


CORPUS = ["page_id", "title", "body", "taxonomy_l1"]


@register("upsert_pages")
def _(spark, sf):
    base, delta = fixture(spark, sf, "fx_corpus"), fixture(spark, sf, "fx_delta")
    return records.upsert(base, delta, ["page_id"], "seq").select(*CORPUS)


@register("union_custom")
def _(spark, sf):
    base, custom = fixture(spark, sf, "fx_corpus"), fixture(spark, sf, "fx_custom")
    return records.union_custom(base, custom, "seq").select(*CORPUS)


@register("reingest_full")
def _(spark, sf):
    """A full load and then the own documents, published as one new snapshot behind the alias."""
    root = fresh_path(spark, "reingest")
    base = records.upsert(fixture(spark, sf, "fx_corpus"), fixture(spark, sf, "fx_delta"), ["page_id"], "seq")
    publish.publish_snapshot(fixture(spark, sf, "fx_corpus"), root, "corpus", "articles", "20260402")
    with_own = records.union_custom(base, fixture(spark, sf, "fx_custom"), "seq")
    name, _ = publish.publish_snapshot(with_own, root, "corpus", "articles", "20260402", ["page_id"])
    return publish.read_alias(spark, root, "corpus").select(*CORPUS, F.lit(name).alias("snapshot"))


@register("publish_snapshot")
def _(spark, sf):
    """Two loads on one day and an empty third: the alias shows the second."""
    root = fresh_path(spark, "catalogue")
    base = fixture(spark, sf, "fx_corpus")
    cluster = ["taxonomy_l1", "page_id"]
    publish.publish_snapshot(base, root, "corpus", "articles", "20260402", cluster)
    later = records.upsert(base, fixture(spark, sf, "fx_delta"), ["page_id"], "seq")
    name, _ = publish.publish_snapshot(later, root, "corpus", "articles", "20260402", cluster)
    publish.publish_snapshot(base.filter(F.col("page_id").isNull()), root, "corpus", "articles", "20260402", cluster)
    return publish.read_alias(spark, root, "corpus").select("page_id", "title", "taxonomy_l1", F.lit(name).alias("snapshot"))


def _loose(spark, sf) -> DataFrame:
    """Articles as text, with ids and dates that cannot be read among them."""
    return fixture(spark, sf, "fx_pages").select(
        F.when(F.col("redirect"), F.concat(F.lit("x"), F.col("page_id"))).otherwise(F.col("page_id").cast("string")).alias("page_id"),
        "title",
        F.col("text").alias("body"),
        F.when(F.col("redirect"), F.lit("never")).otherwise(F.lit(NOW)).alias("fetched_at"),
        F.to_json(F.array("title")).alias("categories_direct"),
        F.lit("left over").alias("unknown"),
    )


@register("apply_schema_contract")
def _(spark, sf):
    df = records.apply_schema_contract(_loose(spark, sf))
    date = F.date_format("fetched_at", records.ISO_SECONDS).alias("fetched_at")
    return df.select("page_id", "title", "body", "url", date, *joined("categories_direct"), "taxonomy_l1")


@register("contract_violations")
def _(spark, sf):
    return records.contract_violations(_loose(spark, sf))


@register("rows_to_docs")
def _(spark, sf):
    rows = _loose(spark, sf).select(
        F.expr("try_cast(page_id as bigint)").alias("page_id"),
        "title",
        F.when(F.contains("body", F.lit("[[Category:fr]]")), F.col("body")).alias("body"),
        F.lit(None).cast("string").alias("url"),
        "fetched_at",
        "categories_direct",
        *[F.lit("").alias(f"categories_{c}") for c in ("level1", "level2", "all")],
        *[F.lit(None).cast("string").alias(f"taxonomy_l{i}") for i in (1, 2, 3)],
    )
    docs = records.rows_to_docs(rows, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    lists = [f"categories_{c}" for c in ("direct", "level1", "level2", "all")]
    return docs.select("page_id", "title", "body", "url", "fetched_at", *joined(*lists), *LEVELS)


@register("encode_list_columns")
def _(spark, sf):
    words = tables(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return records.encode_list_columns(words, ["words"])


# --- streaming -----------------------------------------------------------------------------


@register("stream_custom_docs")
def _(spark, sf):
    """Web pages and corrections streamed into the corpus."""
    root = fresh_path(spark, "stream")
    custom = fixture(spark, sf, "fx_custom")
    for seq in (1, 2):  # later files hold later versions
        custom.filter(F.col("seq") == seq).drop("seq").write.json(f"{root}/in/v{seq}")
    query = ingest.stream_custom_docs(spark, f"{root}/in/*", f"{root}/deltas", f"{root}/checkpoint", 4, now())
    query.awaitTermination()
    return ingest.merge_deltas(fixture(spark, sf, "fx_corpus"), f"{root}/deltas").select(*CORPUS)


# --- text analysis -------------------------------------------------------------------------


def _analyzed(name: str, source: str) -> Query:
    def query(spark, sf):
        df = tables(spark, sf, "documents") if source == "documents" else fixture(spark, sf, source)
        tokens_of = df.select("doc_id", an.ANALYZERS[name](F.col("text")).alias("tokens"))
        return tokens_of.select("doc_id", F.size("tokens").cast("long").alias("n"), *joined("tokens"))

    return query


for _name in ("whitespace", "simple", "stop", "keyword", "pattern"):
    QUERIES[f"tok_{_name}"] = _analyzed(_name, "documents")
QUERIES["tok_standard"] = _analyzed("standard", "fx_ja")


def _token_filter(step: Callable[[Column], Column], source: Callable[[Column], Column]) -> Query:
    def query(spark, sf):
        df = fixture(spark, sf, "fx_ja").select("doc_id", step(source(F.col("text"))).alias("tokens"))
        return df.select("doc_id", F.size("tokens").cast("long").alias("n"), *joined("tokens"))

    return query


QUERIES["tok_cjk_bigram"] = _token_filter(lambda tokens_: tokens_, an.tok_cjk_bigram)
QUERIES["ja_stopwords"] = _token_filter(an.ja_stopwords, an.tok_cjk_bigram)
QUERIES["katakana_stem"] = _token_filter(an.katakana_stem, an.tok_whitespace)
QUERIES["lowercase_tokens"] = _token_filter(an.lowercase_tokens, an.tok_whitespace)
QUERIES["drop_punctuation"] = _token_filter(an.drop_punctuation, an.tok_whitespace)


@register("width_fold")
def _(spark, sf):
    wide = tables(spark, sf, "documents").select("doc_id", F.translate("text", an.ASCII, an.FULL_WIDTH_ASCII).alias("text"))
    both = wide.unionByName(fixture(spark, sf, "fx_ja"))
    return both.select("doc_id", an.width_fold(F.col("text")).alias("text"))


@register("analyze_corpus")
def _(spark, sf):
    rows = tokens.analyze_corpus(fixture(spark, sf, "fx_ja"), "text")
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"))


@register("token_table")
def _(spark, sf):
    return tokens.token_table(tables(spark, sf, "documents"), "text")


def _token_table(analyzer: str, source: str) -> Query:
    def query(spark, sf):
        df = tables(spark, sf, "documents") if source == "documents" else fixture(spark, sf, source)
        return tokens.token_table(df, "text", analyzer=analyzer)

    return query


for _name in ("simple", "stop", "keyword", "pattern"):
    QUERIES[f"token_table_{_name}"] = _token_table(_name, "documents")
QUERIES["token_table_standard"] = _token_table("standard", "fx_ja")
QUERIES["tok_standard_marks"] = _analyzed("standard", "fx_marked")
QUERIES["token_table_marks"] = _token_table("standard", "fx_marked")


@register("segment_lexicon")
def _(spark, sf):
    cut = segmentation.pieces(fixture(spark, sf, "fx_ja"), "text").filter(F.rlike("piece", F.lit(f"^{an.CJK}")))
    return segmentation.count_lexicon(cut.groupBy("piece").agg(F.count("*").alias("n")))


@register("segment_japanese")
def _(spark, sf):
    return segmentation.segment_corpus(fixture(spark, sf, "fx_ja"), "text")


@register("analyze_segmented")
def _(spark, sf):
    rows = segmentation.filter_japanese(segmentation.segment_corpus(fixture(spark, sf, "fx_ja"), "text"))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"))


@register("collocations")
def _(spark, sf):
    return collocations.collocations(_simple_tokens(spark, sf)).select("token", "size", "n", "pmi")


def _simple_tokens(spark, sf) -> DataFrame:
    """The token table of all documents as lists, stored."""
    return materialize(tokens.token_lists(tables(spark, sf, "documents"), "text", analyzer="simple", late=True), "tokens", "zstd")


def _compounds(spark, sf) -> DataFrame:
    """Words of all documents, and their collocations as tokens of several positions."""
    table = _simple_tokens(spark, sf)
    return collocations.add_compounds(table, collocations.collocations(table))


@register("token_table_compounds")
def _(spark, sf):
    return _compounds(spark, sf)


@register("token_graph_nodes")
def _(spark, sf):
    return tokens.token_graph_nodes(_compounds(spark, sf))


@register("token_graph_edges")
def _(spark, sf):
    return tokens.token_graph_edges(_compounds(spark, sf))


@register("token_graph_paths")
def _(spark, sf):
    return collocations.path_counts(_compounds(spark, sf))


@register("token_graph_stop")
def _(spark, sf):
    """Edges over the stop analyzer: nodes are missing where a word was dropped."""
    return tokens.token_graph_edges(tokens.token_table(tables(spark, sf, "documents"), "text", analyzer="stop"))


@register("build_postings")
def _(spark, sf):
    return tokens.build_postings(tables(spark, sf, "documents"), "text", "whitespace")


@register("bm25_topk")
def _(spark, sf):
    docs = tables(spark, sf, "documents").select("doc_id", "text")
    return search.search(docs, fixture(spark, sf, "fx_queries"), K)


@register("metadata_search")
def _(spark, sf):
    scenarios = _listed(spark, sf, "fx_scenarios").withColumn("values", F.create_map(F.lit("text"), F.col("text")))
    records_ = scenarios.withColumnRenamed("scenario_id", "record_id")
    return search.metadata_search(records_, fixture(spark, sf, "fx_scoped_queries"), ["params", "tags", "values"], K)


# --- relevance evaluation ------------------------------------------------------------------


def _judgements(spark, sf) -> DataFrame:
    return fixture(spark, sf, "fx_judgements").withColumnRenamed("idx", "index")


def _hits(spark, sf) -> DataFrame:
    scores = {"longest": F.col("n_chars"), "oldest": -F.col("doc_id")}
    return relevance.ranked_hits(fixture(spark, sf, "fx_judged_docs"), scores, K, "lang", "documents")


def _rated(spark, sf) -> DataFrame:
    return relevance.hits_left_judgements(_hits(spark, sf), _judgements(spark, sf))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@register("ranked_hits")
def _(spark, sf):
    return _hits(spark, sf).withColumnRenamed("index", "idx")


@register("hits_left_judgements")
def _(spark, sf):
    return _rated(spark, sf).select(*relevance.LIST[:1], "strategy_id", "scenario_id", "doc_id", "rank", "rating")


@register("unrated_hits")
def _(spark, sf):
    return relevance.unrated_hits(_hits(spark, sf), _judgements(spark, sf)).select(*relevance.LIST, "doc_id", "rank")


@register("unrated_docs")
def _(spark, sf):
    return relevance.unrated_docs(_hits(spark, sf), _judgements(spark, sf)).withColumnRenamed("index", "idx")


@register("precision_at_k")
def _(spark, sf):
    return _rounded(relevance.precision_at_k(_rated(spark, sf)), "precision")


@register("recall_at_k")
def _(spark, sf):
    return _rounded(relevance.recall_at_k(_rated(spark, sf), _judgements(spark, sf)), "recall")


@register("mrr_at_k")
def _(spark, sf):
    return _rounded(relevance.mrr_at_k(_rated(spark, sf)), "mrr")


@register("dcg_at_k")
def _(spark, sf):
    return _rounded(relevance.dcg_at_k(_rated(spark, sf)), "dcg")


@register("ndcg_at_k")
def _(spark, sf):
    return _rounded(relevance.ndcg_at_k(_rated(spark, sf), _judgements(spark, sf), K), "ndcg")


@register("err_at_k")
def _(spark, sf):
    return _rounded(relevance.err_at_k(_rated(spark, sf), MAX_RATING), "err")


@register("evaluation_metrics")
def _(spark, sf):
    return _rounded(relevance.metrics(_rated(spark, sf), _judgements(spark, sf), K, MAX_RATING), *relevance.METRICS)


@register("evaluation_summary")
def _(spark, sf):
    per_list = relevance.metrics(_rated(spark, sf), _judgements(spark, sf), K, MAX_RATING)
    return _rounded(relevance.evaluation_summary(per_list), *relevance.METRICS)


def _evaluation(spark, sf) -> dict[str, DataFrame]:
    """Two search strategies over all benchmark items."""
    docs = tables(spark, sf, "documents").select("doc_id", "text")
    scenarios = tables(spark, sf, "benchmark").select(
        F.lit("w0").alias("workspace_id"), F.col("item_id").cast("string").alias("scenario_id"), "text"
    )
    hits = search_hits(docs, scenarios, {"plain": "simple", "without_stop_words": "stop"}, K, "documents")
    judgements = fixture(spark, sf, "fx_item_judgements").withColumnRenamed("idx", "index")
    return run_evaluation(hits, judgements, K, MAX_RATING)


@register("evaluation_run")
def _(spark, sf):
    return _rounded(_evaluation(spark, sf)["metrics"], *relevance.METRICS)


@register("evaluation_run_unrated")
def _(spark, sf):
    return _evaluation(spark, sf)["unrated"].withColumnRenamed("index", "idx")


@register("evaluation_job")
def _(spark, sf):
    """Benchmark items as scenarios, strategies with templates, and the nested record of each search."""
    docs = tables(spark, sf, "documents").select("doc_id", "text")
    scenarios = tables(spark, sf, "benchmark").select(
        F.lit("w0").alias("workspace_id"),
        F.col("item_id").cast("string").alias("scenario_id"),
        F.array(F.lit("text")).alias("params"),
        F.create_map(F.lit("text"), F.col("text")).alias("values"),
    )
    strategies = fixture(spark, sf, "fx_search_strategies").withColumn("params", F.split("params", ","))
    judgements = fixture(spark, sf, "fx_item_judgements").withColumnRenamed("idx", "index")
    found = run_benchmark(docs, scenarios, strategies, judgements, K, MAX_RATING, "documents", ["simple", "stop"])
    shown = F.transform("hits", lambda h: F.concat_ws(":", h["hit"]["_id"], F.coalesce(h["rating"].cast("string"), F.lit("-"))))
    return _rounded(found["searches"], *relevance.METRICS).withColumn("hits", F.array_join(shown, ","))


STAMPS = ["created_at", "created_by", "created_via", "updated_at", "updated_by", "updated_via"]


def _stored_judgements(spark, sf) -> DataFrame:
    """Stored ratings with their ids and stamps: those of labelled documents."""
    return _judgements(spark, sf).select(
        relevance.judgement_id().alias("_id"),
        *relevance.JUDGEMENT_KEY,
        "rating",
        F.lit(1).alias("created_at"),
        F.lit("ann").alias("created_by"),
        F.lit("server").alias("created_via"),
        F.lit(None).cast("int").alias("updated_at"),
        F.lit(None).cast("string").alias("updated_by"),
        F.lit(None).cast("string").alias("updated_via"),
    )


def _new_judgements(spark, sf) -> DataFrame:
    """A rating of 1 for the whole corpus, then, later, of 3 for long texts."""
    docs = tables(spark, sf, "documents")

    def rated(chosen: DataFrame, rating: int, seq: int) -> DataFrame:
        return chosen.select(
            F.lit("w0").alias("workspace_id"),
            F.col("lang").alias("scenario_id"),
            F.lit("documents").alias("index"),
            "doc_id",
            F.lit(rating).alias("rating"),
            F.lit(seq).alias("seq"),
        )

    return rated(docs, 1, 2).unionByName(rated(docs.filter(F.col("n_chars") > 1000), 3, 3))


@register("set_judgement")
def _(spark, sf):
    stored = relevance.set_judgements(_stored_judgements(spark, sf), _new_judgements(spark, sf), "seq", "bob")
    return stored.select("_id", "scenario_id", "doc_id", "rating")


@register("stamp_meta")
def _(spark, sf):
    stored = relevance.set_judgements(_stored_judgements(spark, sf), _new_judgements(spark, sf), "seq", "bob")
    return stored.select("_id", *STAMPS)


@register("unset_judgement")
def _(spark, sf):
    stored = _stored_judgements(spark, sf)
    toxic = tables(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id")
    ids = stored.join(toxic, "doc_id", "left_semi").select("_id")
    return relevance.unset_judgements(stored, ids).select("_id", "doc_id", "rating")


def _workspace_records(spark, sf) -> DataFrame:
    """Conversation turns as records: some without a workspace, some with a scale that is no number."""
    return tables(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("record_id"),
        F.when(F.col("role") != "system", F.concat(F.lit("w"), (F.col("conv_id") % 2).cast("string"))).alias("workspace_id"),
        F.lit("0").alias("scale_min"),
        F.when(F.length("text") > 300, F.lit("max")).otherwise(F.length("text").cast("string")).alias("scale_max"),
    )


@register("validate_workspace")
def _(spark, sf):
    accepted, rejected = relevance.validate_workspace(_workspace_records(spark, sf), "w0")
    return accepted.select("record_id", "workspace_id", "scale_min", "scale_max", F.lit("").alias("problem")).unionByName(
        rejected.select("record_id", "workspace_id", F.lit(None).cast("int").alias("scale_min"), F.lit(None).cast("int").alias("scale_max"), "problem")
    )


def _scenario_lines(spark, sf) -> str:
    """Scenarios as JSON lines, with a field that no schema knows."""
    path = fresh_path(spark, "scenarios")
    record = F.struct(
        F.col("scenario_id").alias("_id"),
        "workspace_id",
        "params",
        "tags",
        F.create_map(F.lit("text"), F.col("text"), F.lit("turn"), F.col("turn")).alias("values"),
        F.struct(F.lit("ann").alias("created_by")).alias("@meta"),
        F.col("turn").alias("note"),
    )
    _listed(spark, sf, "fx_scenarios").select(F.to_json(record).alias("value")).write.text(path)
    return path


@register("read_records")
def _(spark, sf):
    found, _ = records.read_records(spark, _scenario_lines(spark, sf), "scenarios")
    return found.select(
        "_id",
        "workspace_id",
        *joined("params", "tags"),
        F.col("values")["text"].alias("text"),
        F.col("@meta.created_by").alias("created_by"),
        F.col("extra")["note"].alias("note"),
        F.size("extra").cast("long").alias("extras"),
    )


@register("select_candidates")
def _(spark, sf):
    scenarios = relevance.choose(_listed(spark, sf, "fx_scenarios"), "scenario_id", tags=["long", "system"])
    strategies = relevance.choose(_listed(spark, sf, "fx_strategies"), "strategy_id", ids=["Brand#1"], tags=["exp"])
    return relevance.select_candidates(scenarios, strategies)


@register("sample_scenarios")
def _(spark, sf):
    return relevance.sample_scenarios(fixture(spark, sf, "fx_scenarios"), 25, "7").select("scenario_id", "workspace_id")


@register("render_strategy")
def _(spark, sf):
    scenarios, strategies = _listed(spark, sf, "fx_scenarios"), _listed(spark, sf, "fx_strategies")
    pairs = relevance.select_candidates(scenarios, strategies)
    values = F.create_map(F.lit("text"), F.col("text"), F.lit("turn"), F.col("turn"))
    return (
        pairs.join(scenarios.select("workspace_id", "scenario_id", "text", "turn"), ["workspace_id", "scenario_id"])
        .join(strategies.select("workspace_id", "strategy_id", "source"), ["workspace_id", "strategy_id"])
        .select("workspace_id", "strategy_id", "scenario_id", relevance.render_strategy(F.col("source"), values).alias("rendered"))
    )


@register("latest_evaluations")
def _(spark, sf):
    found = relevance.latest_evaluations(fixture(spark, sf, "fx_evaluations"), "click", 100)
    return found.select("evaluation_id", "benchmark_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@register("flatten_conversations")
def _(spark, sf):
    """Turns as nested records: lines are rounds, sentences steps, words results; system turns have no rounds."""
    result = lambda step: F.split(step, " ")
    step = lambda s: F.struct(F.lit("sentence").alias("type"), result(s).alias("results"))
    round_ = lambda line: F.struct(
        F.lit("done").alias("status"),
        F.filter(F.transform(F.split(line, r"\. "), step), lambda s: F.size(s["results"]) > 2).alias("steps"),
    )
    rounds = F.when(F.col("role") != "system", F.transform(F.split("text", "\n"), round_)).alias("rounds")
    nested = tables(spark, sf, "conversations").select("conv_id", "turn", rounds)
    return relevance.flatten_conversations(nested, ["conv_id", "turn"])


@register("model_usage")
def _(spark, sf):
    return _rounded(relevance.model_usage(fixture(spark, sf, "fx_rounds")), "avg_time_to_first_token")


@register("compare_strategies")
def _(spark, sf):
    found = comparison.compare_strategies(_evaluation(spark, sf)["metrics"])
    return _rounded(found, "difference", "p_value", "low", "high")


@register("ratings_as_of")
def _(spark, sf):
    hits, history = fixture(spark, sf, "fx_timed_hits"), fixture(spark, sf, "fx_rating_history")
    key = ["workspace_id", "scenario_id", "idx", "doc_id"]
    found = as_of(hits, history, key, "created_at", "rated_at", ["rating"], "seq")
    return found.select("evaluation_id", "strategy_id", "scenario_id", "doc_id", "rating")


GAP, DELAY = "30 minutes", "10 minutes"
EVENTS = "event_id long, ts timestamp, user_id long, value double"


def _use() -> dict[str, Column]:
    return {"total": F.sum(F.col("value").cast("decimal(18,6)")).cast("double"), "largest": F.max("value"), "first_event": F.min("event_id")}


def _events(spark, sf) -> DataFrame:
    """Events, to the millisecond."""
    return tables(spark, sf, "events").select("event_id", F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("ts"), "user_id", "value")


def _shown_sessions(found: DataFrame) -> DataFrame:
    times = {c: F.unix_millis(c) for c in ("session_start", "session_end")}
    return _rounded(found.withColumns(times), "total")


@register("usage_sessions")
def _(spark, sf):
    return _shown_sessions(sessions.sessions(_events(spark, sf), ["user_id"], "ts", GAP, _use()))


def _written_by_file(rows: DataFrame, files: Column, n: int, root: str) -> str:
    """JSON files in the order of their numbers."""
    stored = materialize(rows.withColumn("_file", files), "files")
    for i in range(n):
        stored.filter(F.col("_file") == i).drop("_file").coalesce(1).write.json(f"{root}/in/f{i}")
    return f"{root}/in/*"


@register("usage_sessions_stream")
def _(spark, sf):
    root, events = fresh_path(spark, "sessions"), _events(spark, sf)
    most = events.agg((F.max("event_id") + 1).alias("n")).select("n").scalar()
    source = _written_by_file(events, F.floor(5 * F.col("event_id") / most), 5, root)
    query = sessions.stream_sessions(spark, source, EVENTS, f"{root}/out", f"{root}/checkpoint", ["user_id"], "ts", GAP, DELAY, _use(), 1)
    query.awaitTermination()
    return _shown_sessions(spark.read.parquet(f"{root}/out"))


def _versions(spark, sf) -> DataFrame:
    root = fresh_path(spark, "versions")
    rows = fixture(spark, sf, "fx_event_files").withColumn("ts", F.col("ts").cast("timestamp"))
    source = _written_by_file(rows.select("event_id", "ts", "user_id", F.col("file").alias("n")), F.col("n"), 6, root)
    query = versions.stream_versions(
        spark, source, "event_id long, ts timestamp, user_id long, n int", f"{root}/out", f"{root}/checkpoint", "user_id", "ts", "event_id", "3 days", 1
    )
    query.awaitTermination()
    return versions.read_versions(spark, f"{root}/out")


@register("stream_versions")
def _(spark, sf):
    return _versions(spark, sf).select("event_id", "user_id", "n", "fate")


@register("stream_newest")
def _(spark, sf):
    return versions.newest_versions(_versions(spark, sf), "user_id").select("user_id", "event_id")


@register("search_after_upserts")
def _(spark, sf):
    """Documents, then corrections and withdrawals, then pages, each as a segment of one index."""
    root = fresh_path(spark, "segments")
    segments.add_segment(tables(spark, sf, "documents").select("doc_id", "text"), root, "text")
    segments.add_segment(fixture(spark, sf, "fx_corrected"), root, "text", deleted=fixture(spark, sf, "fx_withdrawn"))
    segments.add_segment(fixture(spark, sf, "fx_added"), root, "text")
    terms = search.query_terms(fixture(spark, sf, "fx_queries"), "text")
    return search.bm25_topk(segments.live_postings(spark, root), terms, K)


FACET_LEVELS = [["l_returnflag", "l_linestatus"], ["l_returnflag"], []]


@register("sketch_facets")
def _(spark, sf):
    """Estimates from merged sketches beside exact counts, and whether they keep their bounds, for every level."""
    leaf = ["everything", *FACET_LEVELS[0]]
    rows = tables(spark, sf, "lineitem").select(F.lit("all").alias("everything"), *FACET_LEVELS[0], F.col("l_suppkey").alias("value"))
    leaves = materialize(sketches.sketch_leaves(rows, leaf, "value"), "leaves")
    out = []
    for kept in FACET_LEVELS:
        levels = ["everything", *kept]
        counts = rows.groupBy(*levels, "value").agg(F.count("*").alias("exact"))
        sizes = counts.groupBy(*levels).agg(F.sum("exact").alias("rows"), F.count("*").alias("n_values"))
        found = sketches.estimates(sketches.merge_up(leaves, levels), levels, K).withColumnRenamed("rows", "sketched")
        off = F.max(F.abs(F.col("n") - F.coalesce("exact", F.lit(0)))).alias("off")
        checked = found.join(counts, [*levels, "value"], "left").groupBy(*levels).agg(
            F.max("n_distinct").alias("n_distinct"), F.max("sketched").alias("sketched"), off, F.count("value").alias("shown")
        )
        near = F.abs(F.col("n_distinct") - F.col("n_values")) <= sketches.distinct_error(F.col("n_values"))
        within = near & (F.col("off") <= sketches.frequency_error(F.col("rows"))) & (F.col("sketched") == F.col("rows"))
        names = [F.col(c) if c in kept else F.lit(None).cast("string").alias(c) for c in FACET_LEVELS[0]]
        out.append(checked.join(sizes, levels).select(*names, "rows", "n_values", "shown", within.alias("within_bounds")))
    return reduce(DataFrame.unionByName, out)
