"""Facet counts, drill-down, top hits and breakdowns.

Equal counts are ordered by key. A null value has no bucket; the empty string has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize


def _counts(df: DataFrame, field: str) -> DataFrame:
    return (
        df.filter(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("key"))
        .agg(F.count(F.lit(1)).alias("doc_count"))
    )


def _values(df: DataFrame, field: str) -> DataFrame:
    """One row per document and distinct value of a list field; counting drops the nulls."""
    return df.select(F.explode_outer(F.array_distinct(field)).alias(field))


def _largest(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("doc_count"), F.asc("key")).limit(n)


def terms(df: DataFrame, field: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of a keyword field."""
    return _largest(_counts(df, field), n)


def terms_multi(df: DataFrame, field: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of a list field; a document counts once per value."""
    return _largest(_counts(_values(df, field), field), n)


def terms_other_count(df: DataFrame, field: str, n: int) -> DataFrame:
    """Documents outside the ``n`` largest buckets: exact, one aggregate reused."""
    counts = _counts(df, field)
    return counts.agg(F.coalesce(F.sum("doc_count"), F.lit(0)).alias("total")).select(
        (F.col("total") - F.coalesce(_largest(counts, n).agg(F.sum("doc_count")).scalar(), F.lit(0))).alias(
            "sum_other_doc_count"
        )
    )


def drilldown(df: DataFrame, fields: list[str], sizes: list[int]) -> DataFrame:
    """Top buckets of the first field, inside each the top of the second, and so on.

    Documents are counted once, at the deepest level, and these counts are stored; upper counts
    are sums of them. Survivors number at most the product of ``sizes``.
    """
    def level(depth: int) -> DataFrame:
        """Documents per path of ``depth`` values; missing deeper values still count above."""
        return (
            leaves.groupBy(*fields[:depth])
            .agg(F.sum("n").alias(f"count_{depth}"))
            .filter(F.col(fields[depth - 1]).isNotNull())
        )

    counted = df.filter(F.col(fields[0]).isNotNull()).groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))
    leaves = materialize(counted, "leaf-counts")
    path = level(1).orderBy(F.desc("count_1"), F.asc(fields[0])).limit(sizes[0])
    for depth in range(2, len(fields) + 1):
        parents, field = fields[: depth - 1], fields[depth - 1]
        rank = F.row_number().over(Window.partitionBy(*parents).orderBy(F.desc(f"count_{depth}"), F.asc(field)))
        kept = level(depth).withColumn("_rank", rank).filter(F.col("_rank") <= sizes[depth - 1]).drop("_rank")
        # Left: a bucket whose documents lack the next field stays, with nothing below it.
        path = path.join(kept, parents, "left")
    return path


def count_in_category(df: DataFrame, category: str, field: str = "categories_all") -> DataFrame:
    """Documents under a category at any level."""
    return df.filter(F.array_contains(field, category)).agg(F.count(F.lit(1)).alias("count"))


def top_hits(df: DataFrame, field: str, buckets: int, hits: int, source: list[str], key: str = "page_id") -> DataFrame:
    """The largest buckets with the first ``hits`` documents of each in key order.

    One scan counts the buckets and reads their field alone; one ranks. Ranking carries the
    ``source`` fields along: each task keeps ``hits`` rows per bucket before anything moves.
    """
    largest = terms(df, field, buckets).select(F.col("key").alias("_bucket"), "doc_count")
    rank = F.row_number().over(Window.partitionBy(field).orderBy(key))
    first = (
        df.filter(F.col(field).isNotNull())
        .select(*dict.fromkeys([field, key, *source]))
        .withColumn("hit", rank)
        .filter(F.col("hit") <= hits)
    )
    # `largest` holds at most `buckets` rows.
    return first.join(F.broadcast(largest), F.col(field) == F.col("_bucket")).select(*source, "doc_count", "hit")


def filtered_terms(df: DataFrame, field: str, value: str, list_field: str, n: int) -> DataFrame:
    """Inside ``field = value``, the ``n`` most frequent values of a list field."""
    return terms_multi(df.filter(F.col(field) == value), list_field, n)


def breakdown(df: DataFrame, fields: list[str]) -> DataFrame:
    """Counts with subtotals at every level; ``level`` is the grouping id.

    Documents are counted before they are repeated per level.
    """
    leaves = df.groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))
    return leaves.rollup(*fields).agg(F.grouping_id().alias("level"), F.sum("n").alias("doc_count"))


def distinct_tags(records: DataFrame, workspace: str, n: int, field: str = "tags") -> DataFrame:
    """Tags of one workspace's records with counts."""
    return terms_multi(records.filter(F.col("workspace_id") == workspace), field, n)
