"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every ``WINDOW - GRAM + 1`` consecutive word k-grams the one of least hash is kept as a
fingerprint, on both sides. Two texts that share ``WINDOW`` words share all k-grams of that
span and so the kept one: no shared span of that length is missed. Shared fingerprints only
nominate; each hit is then extended along its diagonal and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import drop_clashing, materialize, text_key, text_or_empty
from corpusloom.session import salted_join

#: Words of a window that counts as contamination, and words of a k-gram.
WINDOW = 10
GRAM = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OUTPUT = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def raw_words(text: Column) -> Column:
    """Runs of digits, letters and all characters beyond ASCII, as written."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def fold(word: Column) -> Column:
    """The word with A-Z in lower case and all else as it is."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower())
    )


def _shift(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _spans(df: DataFrame, base: str, out: str, width: int, combine) -> DataFrame:
    """``out``: ``base`` combined over ``width`` consecutive places, by doubling; incomplete ones are cut."""
    df, have = df.withColumn(out, F.col(base)), 1
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(out, F.zip_with(out, _shift(F.col(out), step), combine))
        have += step
    return df.withColumn(out, F.slice(out, 1, F.greatest(F.size(base) - (width - 1), F.lit(0))))


def _grams(df: DataFrame, width: int, out: str) -> DataFrame:
    """Hashes of all ``width``-grams of the word hashes ``h``."""
    return _spans(df, "h", out, width, lambda a, b: F.xxhash64(a, b))


def _fingerprints(df: DataFrame, span: int, gram: int, out: str) -> DataFrame:
    """The distinct winnowed hashes of ``h`` that any shared span of ``span`` words must share."""
    df = _grams(df, gram, "_g")
    df = _spans(df, "_g", out, span - gram + 1, lambda a, b: F.least(a, b))
    return df.withColumn(out, F.array_distinct(out)).drop("_g")


def _hashed(df: DataFrame, words: str) -> DataFrame:
    return df.withColumn("h", F.transform(words, lambda w: F.xxhash64(F.lower(w))))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(texts, hits): each row of ``docs`` with its text's key, and what was found per key.

    ``hits`` has, for each distinct text with any hit, ``spans`` (document words hit, as
    disjoint [start, end) ranges), ``n_hit`` and the sorted ``item_ids`` that occur. Items of
    less than ``WINDOW`` words are one window and are searched by all k-grams of their own
    length. Null and empty texts have no words and hit nothing, on either side; null item ids
    count as the empty id.
    """
    items = (
        benchmark.select(
            F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
            raw_words(text_or_empty(item_text)).alias("raw"),
        )
        .filter(F.size("raw") > 0)
        .select("item", F.transform("raw", fold).alias("words"))
        .withColumn("width", F.least(F.size("words"), F.lit(WINDOW)))
    )
    # At most WINDOW widths exist; which of them occur decides what is computed per document.
    widths = sorted(r.width for r in items.select("width").distinct().collect())
    seeds = materialize(
        _by_width(_hashed(items, "words"), widths).distinct(), "item-fingerprints"
    ) if widths else None

    work = docs.select(text_key(text).alias("key"), raw_words(text_or_empty(text)).alias("raw"))
    work = _hashed(work, "raw").withColumn("n_words", F.size("raw"))
    for width in widths:
        work = _fingerprints(work, width, GRAM if width == WINDOW else width, f"f{width}")
    marks = [F.struct(F.lit(w).alias("width"), F.col(f"f{w}").alias("prints")) for w in widths]
    texts = materialize(
        work.select("key", "n_words", (F.array(*marks) if marks else F.array()).alias("marks")), "doc-fingerprints"
    )
    if not widths:
        return texts.select("key", "n_words"), _no_hits(docs.sparkSession)

    nominated = (
        texts.select("key", F.inline("marks"))
        .select("key", "width", F.explode("prints").alias("print"))
        .join(seeds.select("width", "print").distinct(), ["width", "print"], "left_semi")
        .select("key")
        .distinct()
    )
    placed = docs.select(
        text_key(text).alias("key"), text_or_empty(text).alias("text"), F.monotonically_increasing_id().alias("place")
    )
    # Copies of one text are spread, and are one row per task before they meet.
    suspects = materialize(
        salted_join(placed, nominated, ["key"], spread=["place"], how="left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
        .select("key", F.transform(raw_words(F.col("text")), fold).alias("words")),
        "suspects",
    )
    return texts.select("key", "n_words"), _extend(suspects, items, seeds, widths)


def _by_width(items: DataFrame, widths: list[int]) -> DataFrame:
    """(item, width, place, print): the fingerprints of the items, each as often as it was kept."""
    parts = []
    for width in widths:
        gram = GRAM if width == WINDOW else width
        mine = _fingerprints(_grams(items.filter(F.col("width") == width), gram, "all"), width, gram, "kept")
        parts.append(
            mine.select("item", "width", "kept", F.posexplode("all").alias("place", "print"))
            .filter(F.array_contains("kept", F.col("print")))
            .select("item", "width", "place", "print")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _extend(suspects: DataFrame, items: DataFrame, seeds: DataFrame, widths: list[int]) -> DataFrame:
    """Fingerprint hits grown along their diagonals, compared word by word."""
    hashed = _hashed(suspects, "words")
    found = None
    for width in widths:
        gram = GRAM if width == WINDOW else width
        mine = (
            _grams(hashed, gram, "all")
            .select("key", F.posexplode("all").alias("at", "print"))
            .join(seeds.filter(F.col("width") == width), "print")
            .select("key", "item", "width", (F.col("at") - F.col("place")).alias("diagonal"))
        )
        found = mine if found is None else found.unionByName(mine)
    lines = (
        found.distinct()
        .join(suspects, "key")
        .join(items.withColumnRenamed("words", "wanted"), ["item", "width"])
        .withColumn("skip", F.greatest(-F.col("diagonal"), F.lit(0)))
        .withColumn("length", F.least(F.size("wanted") - F.col("skip"), F.size("words") - F.col("diagonal") - F.col("skip")))
        .select(
            "key",
            "item",
            "width",
            "length",
            (F.col("diagonal") + F.col("skip")).alias("from"),
            F.slice("words", F.col("diagonal") + F.col("skip") + 1, F.col("length")).alias("have"),
            F.slice("wanted", F.col("skip") + 1, F.col("length")).alias("want"),
        )
        .filter(F.col("length") >= F.col("width"))
    )
    windows = lines.select(
        "key",
        "item",
        "width",
        "from",
        F.explode(
            F.expr(
                "filter(sequence(1, length - width + 1), o -> slice(have, o, width) = slice(want, o, width))"
            )
        ).alias("o"),
    ).select("key", "item", (F.col("from") + F.col("o") - 1).alias("start"), (F.col("from") + F.col("o") - 1 + F.col("width")).alias("end"))
    windows = materialize(windows, "windows")
    # Windows are turned into disjoint ranges inside one text, never across texts.
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        windows.groupBy("key", "start")
        .agg(F.max("end").alias("end"))
        .withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
        .withColumn("new", F.greatest(F.col("end") - F.greatest("start", "reach"), F.lit(0)))
        .groupBy("key")
        .agg(F.sum("new").alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    named = windows.select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    return ranges.join(named, "key")


def _no_hits(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "key string, n_hit bigint, spans array<struct<start:int,end:int>>, item_ids array<string>"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **columns: str) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids and contaminated added.

    A document word inside any occurrence of an item's window is hit; a document with a hit is
    contaminated. Equal texts are searched once. See ``find_contamination`` for nulls and short
    items. Input columns named like an added one are replaced.
    """
    rows = drop_clashing(docs, *OUTPUT).withColumns(
        {"__op_key": text_key(text), "__op_place": F.monotonically_increasing_id()}
    )
    texts, hits = find_contamination(docs, benchmark, text, **columns)
    counts = texts.groupBy("key").agg(F.first("n_words").alias("n_words"))
    found = counts.join(hits, "key", "left").withColumnRenamed("key", "__op_key")
    # One text may be that of a large share of all rows.
    joined = salted_join(rows, found.drop("spans"), ["__op_key"], spread=["__op_place"])
    return joined.select(
        *(F.col(f"`{c}`") for c in rows.columns if c not in ("__op_key", "__op_place")),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
