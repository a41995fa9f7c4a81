"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    ball_tree,
    decontamination,
    embedding_dedup,
    hard_negatives,
    html_extract,
    license_scan,
    packing,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    topk_search,
    url_filter,
)
from corpusloom.llm.common import text_or_empty

#: The same vocabulary as byte_bpe_50k.json, in the form that is read faster.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents under the law ``key``."""
    shards = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))
    text = text_or_empty()
    return shards.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "law",
        "shard",
        F.col("slot").cast("long").alias("slot"),
        "grown_shard",
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    labelled = spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES, url_filter.train(labelled)).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    labelled = spark.createDataFrame(html_extract.labelled_pages(), "html string, main array<string>")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.train(labelled)).select("page_id", "url", "text", "n_chars")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents, over shingles of four words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=4).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 400 bytes leave of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept_text"
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs).select(
        "doc_id", "license", "coverage", "first_word", "last_word", F.array_join("licenses", ",").alias("licenses")
    )


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item whose id is divisible by 20, of all documents."""
    queries = table(spark, sf_dir, "benchmark").filter("item_id % 20 = 0").withColumnRenamed("item_id", "query_id")
    index, shards = topk_search.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return topk_search.search(index, shards, queries, k=10).select(
        "query_id", F.col("key").alias("doc_id"), "rank", F.round("score", 6).alias("score")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens from all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, VOCABULARY).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors of one label whose cosine is at least 0.98."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    index, shards = ball_tree.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return ball_tree.search(index, shards, items, k=10, query_id="item_id").select("item_id", "rank", F.col("key").alias("doc_id"), "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, among all; every seventh bears a wrong label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op3_license_scan": op3_license_scan,
    "op10_topk_search": op10_topk_search,
    "op4_html_extraction": op4_html_extraction,
    "op2_simhash": op2_simhash,
    "op5_packing": op5_packing,
    "op7_quality": op7_quality,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op9_decontamination": r"""
with items as (
    select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
),
texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
wanted as (
    select distinct item, n, array_to_string(w[o:o + n - 1], ' ') as window_text from (
        select item, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as o from items where len(w) > 0
    )
),
found as (
    select doc_id, item, s, n from (
        select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as window_text from (
            select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from texts join (select distinct n from wanted) on true
        )
    ) join wanted using (n, window_text)
),
hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(s, s + n)) as p from found) group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join hit using (doc_id) left join named using (doc_id)
""",
    "op10_topk_search": r"""
with words as (
    select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) as term from documents
),
postings as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf) as dl from postings group by all),
size as (select (select count(*) from documents) as n, (select sum(dl) from lengths) / (select count(*) from documents) as avgdl),
asked as (
    select query_id, term, count(*) as times from (
        select item_id as query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as term
        from benchmark where item_id % 20 = 0
    ) group by all
),
weights as (
    select query_id, term, times * ln(1 + (n - df + 0.5) / (df + 0.5)) as w
    from asked join (select term, count(*) as df from postings group by all) using (term), size
),
scored as (
    select query_id, doc_id, sum(w * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) order by term) as score
    from weights join postings using (term) join lengths using (doc_id), size
    group by all
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scored
)
select query_id, doc_id, cast(rank as int) as rank, round(score, 6) as score from ranked where rank <= 10
""",
    "op11_embedding_dedup": r"""
with recursive usable as (
    select vec_id, label, cast(embedding as double[]) as v, row_number() over () as r from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.r as u, b.r as v from usable a join usable b
    on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98
),
reach as (
    select r as u, r as v from usable
    union
    select reach.u, links.v from reach join links on reach.v = links.u
),
grouped as (
    select a.vec_id, min(b.vec_id) as component_id, a.r from reach join usable a on reach.u = a.r join usable b on reach.v = b.r group by all
),
counted as (select u, count(*) as n from links group by u)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from grouped left join counted on u = r
union all
select vec_id, 0, vec_id, true from embeddings
where label is null or embedding is null
    or len(list_filter(embedding, lambda x: x is null or not isfinite(x))) > 0
    or len(list_filter(embedding, lambda x: x <> 0)) = 0
""",
    "op12_lexical_search": r"""
with words as (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
),
postings as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, cast(sum(tf) as bigint) as n from postings group by all),
size as (select count(*) as docs, cast(sum(n) as bigint) as total from lengths),
asked as (
    select item_id, term, count(*) as times from (
        select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark
    ) group by all
),
weights as (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w
    from (select term, count(*) as df from postings group by all), size
),
measured as (select doc_id, 25 + (75 * n * docs) // total as m from lengths, size),
scored as (
    select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from asked join weights using (term) join postings using (term) join measured using (doc_id)
    group by all
),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0
)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10
""",
    "op13_hard_negatives": r"""
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
    from usable a join usable b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as int) as rank,
    other_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other_id) <= 3
""",
}
