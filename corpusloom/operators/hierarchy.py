"""Category hierarchy: edges from category pages, two levels of parents per article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.filters import category_page_fields, filter_category_pages, is_category_page
from corpusloom.session import salted_join

def _or_none(names: str) -> Column:
    return F.coalesce(names, F.array().cast("array<string>"))


def _sorted_field(collected: Column, field: str) -> Column:
    return F.transform(F.array_sort(collected), lambda item: item[field])


def category_edges(pages: DataFrame) -> DataFrame:
    """``(child, parent, pos)``; of several pages of one category the greatest id counts."""
    last = filter_category_pages(pages).groupBy("category").agg(F.max_by("parents", "page_id").alias("parents"))
    return last.select(F.col("category").alias("child"), F.posexplode("parents").alias("pos", "parent")).select(
        "child", "parent", "pos"
    )


def category_lookup(edges: DataFrame) -> DataFrame:
    """One row per category: ordered parents, and the ordered parents of each of those.

    Both lists stem from one category page's own links, so no group outgrows a page. A parent
    named by very many categories is a hot join key and is spread.
    """
    parents = edges.groupBy("child").agg(
        _sorted_field(F.collect_list(F.struct("pos", "parent")), "parent").alias("parents")
    )
    grand = salted_join(
        edges,
        parents.select(F.col("child").alias("parent"), F.col("parents").alias("grand")),
        ["parent"],
        spread=["child"],
    )
    return grand.groupBy("child").agg(
        _sorted_field(F.collect_list(F.struct("pos", "parent")), "parent").alias("parents"),
        F.flatten(
            _sorted_field(F.collect_list(F.struct("pos", _or_none("grand").alias("grand"))), "grand")
        ).alias("grandparents"),
    )


def parents_level1(direct: Column, parents: Column) -> Column:
    """Parents that are not direct categories, first-seen order."""
    return F.array_except(parents, direct)


def parents_level2(direct: Column, level1: Column, grandparents: Column) -> Column:
    """Parents of all parents that are neither direct nor level 1, first-seen order."""
    return F.array_except(grandparents, F.concat(direct, level1))


def categories_all(direct: Column, level1: Column, level2: Column) -> Column:
    """Direct, level 1 and level 2 together, distinct."""
    return F.array_distinct(F.concat(direct, level1, level2))


def resolve_hierarchy(articles: DataFrame, edges: DataFrame, salts: int = 8, carry: tuple[str, ...] = ()) -> DataFrame:
    """``page_id`` with its direct, level 1, level 2 and all categories.

    Takes ``(page_id, categories_direct)`` and the short columns in ``carry``, which spare a
    join when they are needed next; longer ones are joined back by ``page_id``. The regrouping
    by page gathers only what the page itself lists.
    """
    links = articles.select("page_id", *carry, F.posexplode_outer("categories_direct").alias("pos", "child"))
    found = salted_join(links, category_lookup(edges), ["child"], spread=["page_id"], salts=salts)
    item = F.struct(
        "pos",
        "child",
        _or_none("parents").alias("parents"),
        _or_none("grandparents").alias("grandparents"),
    )
    grouped = (
        found.groupBy("page_id", *carry)
        .agg(F.array_sort(F.collect_list(item)).alias("found"))
        .withColumn("categories_direct", F.array_compact(F.transform("found", lambda f: f["child"])))
    )
    level1 = parents_level1(F.col("categories_direct"), F.flatten(F.transform("found", lambda f: f["parents"])))
    level2 = parents_level2(
        F.col("categories_direct"),
        F.col("categories_level1"),
        F.flatten(F.transform("found", lambda f: f["grandparents"])),
    )
    return (
        grouped.withColumn("categories_level1", level1)
        .withColumn("categories_level2", level2)
        .select(
            "page_id",
            *carry,
            "categories_direct",
            "categories_level1",
            "categories_level2",
            categories_all(
                F.col("categories_direct"), F.col("categories_level1"), F.col("categories_level2")
            ).alias("categories_all"),
        )
    )


def category_coverage(pages: DataFrame) -> DataFrame:
    """Pages scanned, category pages that yield parents, and categories mapped."""
    read = category_page_fields(pages)
    yields = is_category_page() & (F.col("category") != "") & (F.size("parents") > 0)
    return read.withColumn("yields", F.coalesce(yields, F.lit(False))).agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if("yields").alias("mapped_pages"),
        F.count_distinct(F.when(F.col("yields"), F.col("category"))).alias("mapped"),
    )
