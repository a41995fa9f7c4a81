"""The ingest job: pages in, classified articles out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators.filters import filter_articles
from corpusloom.operators.hierarchy import category_edges, resolve_hierarchy
from corpusloom.operators.taxonomy import classify_taxonomy
from corpusloom.schemas import ARTICLES
from corpusloom.session import materialize


def article_categories(pages: DataFrame) -> DataFrame:
    """``(page_id, title, categories_direct)`` of every article, without its text."""
    return filter_articles(pages).select(
        "page_id", "title", tx.extract_categories(F.col("text")).alias("categories_direct")
    )


def classify(articles: DataFrame, edges: DataFrame, rules: DataFrame) -> DataFrame:
    """``(page_id, title, four category lists, three taxonomy levels)`` for narrow articles."""
    return classify_taxonomy(resolve_hierarchy(articles, edges, carry=("title",)), rules)


def build_articles(
    pages: DataFrame, rules: DataFrame, now: Column, chars: int | None = None, url_base: str = tx.WIKI_URL_BASE
) -> DataFrame:
    """The twelve-field article table of stored pages, articles and category pages together.

    Bodies are whole; ``chars`` cuts them for a caller that asks for it.

    Texts are cleaned once and stored; hierarchy and taxonomy then read ids, titles and
    category names only, and bodies join once at the end. Both sides of that join are unique
    by page.
    """
    articles = materialize(
        filter_articles(pages).select(
            "page_id",
            "title",
            (F.col("body") if chars is None else tx.truncate_body(F.col("body"), chars)).alias("body"),
            tx.wiki_url(F.col("title"), url_base).alias("url"),
            tx.extract_categories(F.col("text")).alias("categories_direct"),
        ),
        "articles",
    )
    narrow = articles.select("page_id", "title", "categories_direct")
    classified = classify(narrow, category_edges(pages), rules).drop("title", "categories_direct")
    return articles.withColumn("fetched_at", now).join(classified, "page_id").select(*ARTICLES.names)
