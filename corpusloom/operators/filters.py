"""Row filters, projections and limits over pages and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Namespaces of the dump.
ARTICLE_NS = 0
CATEGORY_NS = 14


def _filled(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & (F.col(name).cast("string") != "")
    return F.coalesce(condition, F.lit(False))


def filter_articles(pages: DataFrame) -> DataFrame:
    """Article pages with their plain text in ``body``.

    The cheap tests come first, so cleaning runs on article pages only; pages whose cleaned
    text is empty go afterwards.
    """
    kept = pages.filter((F.col("ns") == ARTICLE_NS) & ~F.col("redirect") & _filled("title", "page_id", "text"))
    return tx.strip_wikitext(kept, "text", "body").filter(F.col("body") != "")


def is_category_page() -> Column:
    """A category page with title and text that is no redirect."""
    return (F.col("ns") == CATEGORY_NS) & ~F.col("redirect") & _filled("title", "text")


def category_page_fields(pages: DataFrame) -> DataFrame:
    """``pages`` with the ``category`` and ``parents`` of category pages; null for others."""
    ours = is_category_page()
    return pages.withColumns(
        {
            "category": F.when(ours, tx.category_from_title(F.col("title"))),
            "parents": F.when(ours, tx.extract_categories(F.col("text"))),
        }
    )


def filter_category_pages(pages: DataFrame) -> DataFrame:
    """Category pages as ``(page_id, category, parents)``; both must be non-empty."""
    fields = category_page_fields(pages.filter(is_category_page()))
    return fields.select("page_id", "category", "parents").filter((F.col("category") != "") & (F.size("parents") > 0))


def limit_rows(df: DataFrame, n: int, key: str = "page_id") -> DataFrame:
    """The first ``n`` rows in key order; 0 keeps all."""
    return df.orderBy(key).limit(n) if n > 0 else df


def keyset_page(df: DataFrame, last: int, n: int, key: str = "page_id") -> DataFrame:
    """The page of ``n`` rows after key ``last``; the greatest key of it is the next cursor."""
    return df.filter(F.col(key) > last).orderBy(key).limit(n)


def term_filter(df: DataFrame, field: str, value: str) -> DataFrame:
    """Exact match on a keyword field."""
    return df.filter(F.col(field) == value)


def term_filter_multi(df: DataFrame, field: str, value: str) -> DataFrame:
    """Exact match on any value of a list field."""
    return df.filter(F.array_contains(field, value))


def source_includes(df: DataFrame, fields: list[str]) -> DataFrame:
    """Keep the listed fields only."""
    return df.select(*fields)
