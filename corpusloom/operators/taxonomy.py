"""Three-level taxonomy from ordered keyword rules.

The rules are a parameter: rows ``(rule_ord, l1, l2, keyword)``. The first rule, by
``rule_ord``, with any keyword inside title and categories decides levels one and two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.collocations import may_hold
from corpusloom.schemas import TAXONOMY_RULE
from corpusloom.session import materialize, salted_join

# Names given to a page that no rule matches.
OTHER = "その他"
UNCLASSIFIED = "未分類"

#: Characters of the longest gram by which keywords are found, and characters of a text that are cut into grams at once.
GRAM = 16
BLOCK = 128

_RULE = "struct<rule_ord:int,l1:string,l2:string,keywords:array<string>>"


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from JSON lines with the fields ``rule_ord, l1, l2, keyword``."""
    return spark.read.schema(TAXONOMY_RULE).option("mode", "FAILFAST").json(path)


def rules_value(rules: DataFrame) -> Column:
    """All rules as one array of ``(rule_ord, l1, l2, keywords)``, in order, as a scalar subquery.

    Spark reads the rules once, as one aggregated row, when the query runs. Rules are
    configuration: that row is as large as the rule file.
    """
    words = F.array_sort(F.collect_set("keyword")).alias("keywords")
    grouped = rules.groupBy(F.col("rule_ord").cast("int").alias("rule_ord"), "l1", "l2").agg(words)
    return grouped.agg(F.array_sort(F.collect_list(F.struct("rule_ord", "l1", "l2", "keywords")))).scalar()


def first_rule(rules: Column, holds: Callable[[Column], Column]) -> Column:
    """The first rule that holds, else null; rules after it are not tried."""
    return F.aggregate(
        rules,
        F.lit(None).cast(_RULE),
        lambda found, rule: F.when(found.isNotNull(), found).when(holds(rule), rule),
    )


def classify_taxonomy(articles: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``taxonomy_l1``, ``taxonomy_l2``, ``taxonomy_l3`` from title and categories.

    Level three is the first direct category holding a matched keyword, else the first of all
    categories that does, else the first direct category, else the level two name. The text
    searched is title and category names, never the body.
    """
    holds_any = lambda text, words: F.exists(words, lambda w: F.contains(text, w))
    first_holding = lambda names, words: F.try_element_at(
        F.filter(names, lambda name: holds_any(name, words)), F.lit(1)
    )
    first_direct = F.try_element_at("categories_direct", F.lit(1))
    with_rule = (
        articles.withColumn("_corpus", F.concat_ws(" ", "title", "categories_all"))
        .withColumn("_rules", rules_value(rules))
        .withColumn(
            "_rule",
            first_rule(F.col("_rules"), lambda rule: holds_any(F.col("_corpus"), rule["keywords"])),
        )
        .withColumn("_matched", F.filter("_rule.keywords", lambda word: F.contains(F.col("_corpus"), word)))
    )
    level3 = F.coalesce(
        first_holding(F.col("categories_direct"), F.col("_matched")),
        first_holding(F.col("categories_all"), F.col("_matched")),
        first_direct,
        F.col("_rule.l2"),
        F.lit(UNCLASSIFIED),
    )
    return (
        with_rule.withColumn("taxonomy_l1", F.coalesce("_rule.l1", F.lit(OTHER)))
        .withColumn("taxonomy_l2", F.coalesce("_rule.l2", F.lit(UNCLASSIFIED)))
        .withColumn("taxonomy_l3", level3)
        .drop("_corpus", "_rules", "_rule", "_matched")
    )


def _anchors(keywords: DataFrame) -> DataFrame:
    """``(keyword, gram)``: a keyword is found by itself, one of over ``GRAM`` characters by that of its grams which the fewest keywords hold."""
    long = keywords.filter(F.char_length("keyword") > GRAM)
    starts = F.sequence(F.lit(1), F.char_length("keyword") - GRAM + 1)
    grams = long.select("keyword", F.explode(F.array_distinct(F.transform(starts, lambda at: F.substring("keyword", at, F.lit(GRAM))))).alias("gram"))
    held = grams.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = grams.join(held, "gram").groupBy("keyword").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return keywords.filter(F.char_length("keyword") <= GRAM).select("keyword", F.col("keyword").alias("gram")).unionByName(rarest)


def keyword_matches(texts: DataFrame, keywords: DataFrame) -> DataFrame:
    """``(id, keyword)`` for every keyword that a text holds, without trying each keyword on each text.

    ``texts`` has distinct ``id`` and ``text``, ``keywords`` distinct ``keyword`` of at least one character. The
    substrings of texts that have the length of a keyword, up to ``GRAM`` characters, meet the keywords as equals; of
    them only those are moved whose hash a keyword may have, and no text is.
    """
    index = materialize(_anchors(keywords), "keyword-grams")
    sizes = index.agg(F.sort_array(F.collect_set(F.char_length("gram"))).alias("sizes")).select("sizes").scalar()
    # Cut off a block, a gram costs no walk through the whole text.
    begins = F.sequence(F.lit(1), F.greatest(F.char_length("text"), F.lit(1)), F.lit(BLOCK))
    blocks = texts.select("id", "text", F.explode(begins).alias("at")).select("id", F.substring("text", F.col("at"), F.lit(BLOCK + GRAM - 1)).alias("block"))
    places = blocks.select("id", "block", F.explode(F.sequence(F.lit(1), F.least(F.char_length("block"), F.lit(BLOCK)))).alias("at"))
    sized = places.select("id", F.substring("block", F.col("at"), F.lit(GRAM)).alias("rest"), F.explode(F.coalesce(sizes, F.array().cast("array<int>"))).alias("n"))
    grams = sized.filter(F.char_length("rest") >= F.col("n")).select("id", F.substring("rest", F.lit(1), F.col("n")).alias("gram"))
    maybe = may_hold(grams, index.select(F.xxhash64("gram").alias("hash")), F.xxhash64("gram")).distinct()
    # One keyword may be in a large share of all texts.
    met = materialize(salted_join(maybe, index, ["gram"], spread=["id"], how="inner").select("id", "keyword"), "met")
    short = met.filter(F.char_length("keyword") <= GRAM)
    long = met.filter(F.char_length("keyword") > GRAM).join(texts.select("id", "text").hint("merge"), "id").filter(F.contains("text", "keyword"))
    return short.unionByName(long.select("id", "keyword"))


def classify_by_index(articles: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """The same rows as ``classify_taxonomy``, for rule tables of very many keywords; ``key`` must be unique.

    Titles and category names repeat, so keywords are looked up once per distinct name. A keyword
    without a space that stands in the searched text stands in one name of it; only keywords with
    a space are also looked up in the whole text. Neither rules nor matches are gathered.
    """
    rule = F.struct(F.col("rule_ord").cast("int").alias("rule_ord"), "l1", "l2").alias("rule")
    words = materialize(rules.filter(F.col("keyword").isNotNull()).select(rule, "keyword").distinct(), "keywords")
    ever = lambda condition: F.coalesce(words.agg(F.max(condition).alias("ever")).select("ever").scalar(), F.lit(False))
    empty = ever(F.col("keyword") == "")
    # Names are joined by spaces; the empty keyword is in every text, that without names too.
    wide = ever(F.contains("keyword", F.lit(" ")) | (F.col("keyword") == ""))
    part = lambda kind, pos, text: F.struct(F.lit(kind).alias("kind"), pos.alias("pos"), text.alias("text"))
    listed = lambda kind, names: F.coalesce(F.transform(names, lambda n, i: part(kind, i, n)), F.array())
    whole = F.array(part(3, F.lit(0), F.concat_ws(" ", "title", "categories_all")))
    every = F.concat(
        F.array(part(0, F.lit(0), F.col("title"))),
        listed(1, F.col("categories_direct")),
        listed(2, F.col("categories_all")),
        F.when(wide, whole).otherwise(F.array()),
    )
    names = materialize(
        articles.select(F.col(key).alias("key"), F.explode(every).alias("n")).select("key", "n.*").filter(F.col("text").isNotNull()), "names"
    )
    texts = materialize(names.select("text").distinct().select("text", F.monotonically_increasing_id().alias("id")), "texts")
    matches = keyword_matches(texts, words.select("keyword").filter("keyword <> ''").distinct())
    # Tables with a row per page or name compress so well that Spark would take them for small and gather them
    # in the driver for a broadcast, eight times over where a join is salted; they are merged.
    merged = lambda df: df.hint("merge")
    # From here on a text is a number. A category may belong to a large share of all pages.
    numbered = materialize(salted_join(names, merged(texts), ["text"], spread=["key"], how="inner").select("key", "kind", "pos", "id"), "numbered-names")
    with_empty = matches.unionByName(texts.filter(empty).select("id", F.lit("").alias("keyword")))
    # One keyword may be in a large share of all texts.
    found = materialize(salted_join(with_empty, merged(words), ["keyword"], spread=["id"], how="inner"), "matches")
    of_text = found.groupBy("id").agg(F.min("rule").alias("rule"))
    first = salted_join(numbered.filter("kind <> 1"), merged(of_text), ["id"], spread=["key"], how="inner")
    ruled = materialize(first.groupBy("key").agg(F.min("rule").alias("rule")), "page-rules")
    asked = materialize(numbered.join(merged(ruled), "key"), "ruled-names")
    # Most keywords of a text are of other rules than that of its pages: they go before what is left is repeated per salt.
    used = found.join(merged(asked.select("id", "rule").distinct()), ["id", "rule"], "left_semi")
    hits = materialize(salted_join(asked, merged(used), ["id", "rule"], spread=["key"], how="inner"), "hits")
    matched = hits.filter("kind <> 1").select("key", "keyword").distinct()
    third = (
        hits.filter("kind in (1, 2)")
        .join(merged(matched), ["key", "keyword"], "left_semi")
        .groupBy("key")
        .agg(F.min_by("id", F.struct("kind", "pos")).alias("id"))
    )
    named = salted_join(materialize(third, "third"), merged(texts), ["id"], spread=["key"], how="inner").select("key", F.col("text").alias("name"))
    by_key = lambda df: merged(df.withColumnRenamed("key", key))
    joined = articles.join(by_key(ruled), key, "left").join(by_key(named), key, "left")
    level3 = F.coalesce("name", F.try_element_at("categories_direct", F.lit(1)), "rule.l2", F.lit(UNCLASSIFIED))
    return joined.select(
        *(F.col(f"`{c}`") for c in articles.columns),
        F.coalesce("rule.l1", F.lit(OTHER)).alias("taxonomy_l1"),
        F.coalesce("rule.l2", F.lit(UNCLASSIFIED)).alias("taxonomy_l2"),
        level3.alias("taxonomy_l3"),
    )
