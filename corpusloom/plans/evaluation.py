"""The evaluation job: search strategies run over scenarios and scored against judgements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import relevance
from corpusloom.operators.search import search
from corpusloom.session import materialize


def search_hits(docs: DataFrame, scenarios: DataFrame, analyzers: dict[str, str], k: int, index: str) -> DataFrame:
    """Top ``k`` hits of each ``(strategy, scenario)``; a strategy is BM25 with its own analyzer.

    ``docs`` are ``(doc_id, text)``, ``scenarios`` are ``(workspace_id, scenario_id, text)``.
    """
    asked = scenarios.select(F.struct(*relevance.SCENARIO).alias("query_id"), "text")
    lists = [
        search(docs, asked, k, analyzer=analyzer).select("query_id.*", "rank", "doc_id", "score", F.lit(strategy).alias("strategy_id"))
        for strategy, analyzer in analyzers.items()
    ]
    hits = reduce(DataFrame.unionByName, lists)
    return hits.select(*relevance.LIST, F.lit(index).alias("index"), "doc_id", "score", "rank")


def run_evaluation(hits: DataFrame, judgements: DataFrame, k: int, max_rating: int) -> dict[str, DataFrame]:
    """``metrics`` per list, their ``summary`` per strategy, and the ``unrated`` documents.

    Hits are stored first: they are few, three results read them, and finding them is the
    expensive part.
    """
    hits = materialize(hits, "hits")
    rated = relevance.hits_left_judgements(hits, judgements)
    per_list = relevance.metrics(rated, judgements, k, max_rating)
    return {
        "metrics": per_list,
        "summary": relevance.evaluation_summary(per_list),
        "unrated": relevance.unrated_docs(hits, judgements),
    }


def strategy_queries(scenarios: DataFrame, strategies: DataFrame) -> DataFrame:
    """``(workspace_id, strategy_id, scenario_id, analyzer, text)``: what each runnable pair asks.

    Scenarios carry ``params`` and the map ``values``, strategies ``params``, the JSON template
    ``source`` and their ``analyzer``; the text is the template's field ``q``. Values are escaped
    for JSON before they are filled in.
    """
    escaped = F.transform_values(
        "values", lambda _, v: F.regexp_extract(F.to_json(F.struct(v.alias("v"))), r'(?s)\A\{"v":"(.*)"\}\z', 1)
    )
    rendered = relevance.render_strategy(F.col("source"), F.col("_values"))
    return (
        relevance.select_candidates(scenarios, strategies)
        .join(scenarios.select(*relevance.SCENARIO, escaped.alias("_values")), relevance.SCENARIO)
        .join(strategies.select("workspace_id", "strategy_id", "source", "analyzer"), ["workspace_id", "strategy_id"])
        .select(*relevance.LIST, "analyzer", F.get_json_object(rendered, "$.q").alias("text"))
    )


def run_benchmark(
    docs: DataFrame,
    scenarios: DataFrame,
    strategies: DataFrame,
    judgements: DataFrame,
    k: int,
    max_rating: int,
    index: str,
    analyzers: list[str],
) -> dict[str, DataFrame]:
    """An evaluation from candidates to records: ``metrics``, ``summary``, ``unrated`` and ``searches``.

    Chosen scenarios meet the strategies that they give all parameters for; each pair's template
    is rendered, searched with the strategy's analyzer, and scored. ``searches`` has one nested
    record per list, with its metrics and its at most ``k`` hits with their ratings.
    """
    asked = materialize(strategy_queries(scenarios, strategies), "asked")
    lists = [
        search(docs, asked.filter(F.col("analyzer") == a).select(F.struct(*relevance.LIST).alias("query_id"), "text"), k, analyzer=a)
        for a in analyzers
    ]
    hits = reduce(DataFrame.unionByName, lists).select(
        "query_id.*", F.lit(index).alias("index"), "doc_id", "score", "rank"
    )
    stored = materialize(hits, "hits")
    out = run_evaluation(stored, judgements, k, max_rating)
    hit = F.struct("rank", F.struct(F.col("doc_id").alias("_id"), F.col("score").alias("_score")).alias("hit"), "rating")
    nested = (
        relevance.hits_left_judgements(stored, judgements)
        .groupBy(*relevance.LIST)
        .agg(F.array_sort(F.collect_list(hit)).alias("hits"))  # at most k
    )
    return out | {"searches": out["metrics"].join(nested, relevance.LIST)}
