"""Ranked full-text search over postings, for a batch of queries at once.

BM25 after Robertson and Zaragoza (2009) with exact document lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.tokens import build_postings, postings_and_lengths
from corpusloom.session import materialize

# The usual BM25 constants.
K1 = 1.2
B = 0.75

#: Decimals of a score that are shown, and the type in which scores are summed and ranked.
SCORE_DECIMALS = 6
SCORE_TYPE = "decimal(28,12)"
#: Words in more than this share of the documents are added last, where they can matter.
RARE_SHARE = 0.05


def query_terms(queries: DataFrame, text: str, analyzer: str = "simple", query: str = "query_id") -> DataFrame:
    """``(query, term, qtf)``: analyzed queries, repeated terms counted."""
    return build_postings(queries, text, analyzer, query).select(query, "term", F.col("tf").alias("qtf"))


def bm25_topk(
    postings: DataFrame,
    terms: DataFrame,
    k: int,
    key: str = "doc_id",
    query: str = "query_id",
    scope: tuple[str, ...] = (),
    rare_share: float = RARE_SHARE,
) -> DataFrame:
    """``(scope, query, rank, key, score)``: the ``k`` best documents of each query, ties by key.

    ``postings`` hold a row of null term per document, as ``postings_and_lengths`` makes them;
    corpus totals come from those. With ``scope`` columns (a workspace) both sides carry them,
    and totals, frequencies and ranks are per scope.

    Words that are in more than ``rare_share`` of the documents are left out of the first pass.
    The k-th score of that pass is a floor of the final one. Frequent words are then added only
    to documents that can still reach it; a query whose frequent words could lift an unseen
    document to the floor is scored in full. The result is exact either way. Scores are sums of
    decimals, so ranks do not depend on how rows are partitioned; only the shown score is rounded.
    """
    on = list(scope)
    sized = postings.filter(F.col("term").isNull()).groupBy(*on).agg(
        F.count(F.lit(1)).alias("docs"), F.avg("doc_len").alias("mean_len")
    )
    held = postings.filter(F.col("term").isNotNull())
    totals = {c: sized.select(c).scalar() for c in ("docs", "mean_len")} if not on else {}
    by_scope = lambda df: df.join(sized, on) if on else df.withColumns(totals)
    tf_part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / F.col("mean_len")))
    wanted = terms.select(*on, "term").distinct()
    # Counted first, then joined: of each term one row is moved per task.
    counted = by_scope(held).groupBy(*on, "term", "docs", "mean_len").agg(F.count(F.lit(1)).alias("df"), F.max(tf_part).alias("most"))
    frequency = counted.join(wanted, [*on, "term"])
    idf = F.ln(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = materialize(
        terms.join(frequency, [*on, "term"]).select(
            *on, query, "term", "mean_len", (F.col("qtf") * idf).alias("weight"), "most", (F.col("df") > rare_share * F.col("docs")).alias("frequent")
        ),
        "weights",
    )
    most = F.col("weight") * F.col("most")  # no document adds more for a word
    bounds = weighted.groupBy(*on, query).agg(F.sum(F.when(F.col("frequent"), most).otherwise(0.0)).alias("rest"))

    def scored(chosen: DataFrame, found: DataFrame) -> DataFrame:
        part = (F.col("weight") * tf_part).cast(SCORE_TYPE)
        return found.join(chosen, [*on, "term"]).groupBy(*on, query, key).agg(F.sum(part).alias("score"))

    rank_of = lambda part: Window.partitionBy(*on, query).orderBy(*part)
    first = materialize(scored(weighted.filter(~F.col("frequent")), held), "first-pass")
    kth = (
        first.withColumn("_n", F.row_number().over(rank_of([F.desc("score")])))
        .filter(F.col("_n") == k)
        .select(*on, query, F.col("score").alias("floor"))
    )
    out_of_reach = F.col("rest") < F.col("floor").cast("double") * (1 - 1e-9)
    plan = bounds.join(kth, [*on, query], "left").withColumn("full", ~F.coalesce(out_of_reach, F.lit(False)))
    in_full = plan.filter("full").select(*on, query)
    whole = scored(weighted.join(in_full, [*on, query], "left_semi"), held)
    reach = (
        first.join(plan.filter("not full"), [*on, query])
        .filter(F.col("score").cast("double") + F.col("rest") >= F.col("floor").cast("double") * (1 - 1e-9))
        .select(*on, query, key, "score")
    )
    more = (
        reach.select(*on, query, key)
        .join(weighted.filter("frequent"), [*on, query])
        .join(held, [*on, "term", key])
        .select(*on, query, key, (F.col("weight") * tf_part).cast(SCORE_TYPE).alias("score"))
    )
    pruned = reach.unionByName(more).groupBy(*on, query, key).agg(F.sum("score").alias("score"))
    rank = F.row_number().over(rank_of([F.desc("score"), F.asc(key)]))
    return (
        whole.unionByName(pruned)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select(*on, query, "rank", key, F.round(F.col("score").cast("double"), SCORE_DECIMALS).alias("score"))
    )


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    doc_text: str = "text",
    query_text: str = "text",
    analyzer: str = "simple",
    key: str = "doc_id",
    query: str = "query_id",
) -> DataFrame:
    """Answer all ``queries`` from the postings of their terms in ``docs``; these are stored, as they are read several times."""
    terms = materialize(query_terms(queries, query_text, analyzer, query), "query-terms")
    asked = materialize(terms.select("term").distinct(), "asked")
    postings = materialize(postings_and_lengths(docs, doc_text, analyzer, key, asked), "postings")
    return bm25_topk(postings, terms, k, key, query)


def metadata_search(
    records: DataFrame, queries: DataFrame, fields: list[str], k: int, key: str = "record_id", query: str = "query_id"
) -> DataFrame:
    """Full-text search over the searchable fields of records, inside each workspace.

    Of lists and maps the values are searched. Queries name their ``workspace_id``, and are
    answered from its records and its word frequencies alone.
    """
    kinds = dict(records.dtypes)

    def searchable(name: str) -> Column:
        kind = kinds.get(name, "")
        if kind.startswith("map"):
            return F.array_join(F.map_values(name), " ")
        return F.array_join(name, " ") if kind.startswith("array") else F.col(name).cast("string")

    shadow = records.select(
        F.struct("workspace_id", key).alias("_id"), F.concat_ws(" ", *map(searchable, fields)).alias("_search")
    )
    asked = queries.select(F.struct("workspace_id", query).alias("_id"), "text")
    terms = materialize(query_terms(asked, "text", "standard", "_id").select("_id.*", "term", "qtf"), "query-terms")
    wanted = materialize(terms.select("term").distinct(), "asked")
    found = postings_and_lengths(shadow, "_search", "standard", "_id", wanted)
    postings = materialize(found.select("term", "_id.*", "tf", "doc_len"), "postings")
    return bm25_topk(postings, terms, k, key, query, scope=("workspace_id",))
