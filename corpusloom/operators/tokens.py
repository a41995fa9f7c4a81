"""Token tables, token graphs and postings of whole corpora."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.analysis import ANALYZERS, RUNS
from corpusloom.session import salted_join

# Fixed value: the token type that analyzers give.
WORD_TYPE = "word"

#: What tokens are marked with, and characters that stand for it where a text holds it itself: none is
#: ever a character of a text by the rules of Unicode, and every analyzer takes them as it takes the mark.
MARK = "\x00"
SPARE = "".join(map(chr, (*range(0xFDD0, 0xFDF0), 0xFFFE, 0xFFFF)))
NO_MARK = "no character is left to mark tokens with"
#: Bytes of text whose characters are counted at once, and runs that are added up before they are appended.
SHARE = 1 << 22
BLOCK = 128


def analyze_corpus(docs: DataFrame, text: str, analyzer: str = "japanese", key: str = "doc_id") -> DataFrame:
    """``(key, position, token)`` rows; no shuffle.

    The outer form of explode: for the inner form Spark adds a filter on the list's size and
    so analyzes every text again.
    """
    exploded = docs.select(key, F.posexplode_outer(ANALYZERS[analyzer](F.col(text))).alias("position", "token"))
    return exploded.filter(F.col("token").isNotNull())


def _starts(marked: Column) -> Column:
    """For each text the offsets, in code points, at which its marked tokens start.

    The texts' bytes are counted in numpy, some megabytes at a time, and four bytes a token
    come back. The function is local, so that workers need no copy of this package.
    """
    share = SHARE

    def starts(texts: pa.Array) -> pa.Array:
        whole = texts.cast(pa.large_binary())
        ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
        found, counts, at = [], np.zeros(len(whole) + 1, np.int64), 0
        while at < len(whole):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + share, "right")) - 1)
            part = data[ends[at] : ends[to]]
            marks = np.flatnonzero(part == 0)
            text = np.searchsorted(marks, ends[at : to + 1] - ends[at])  # marks before each text
            chars = np.cumsum((part & 0xC0) != 0x80, dtype=np.int64)
            before = np.concatenate([[0], chars])[ends[at : to + 1] - ends[at]]
            opens, texts_of = marks[::2], np.repeat(np.arange(to - at), np.diff(text) // 2)
            # Characters up to the mark, without the marks.
            found.append((chars[opens] - 1 - before[:-1][texts_of] - (2 * np.arange(len(opens)) - text[:-1][texts_of])).astype(np.int32))
            counts[at + 1 : to + 1] = np.diff(text) // 2
            at = to
        values = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), pa.array(values))

    return F.arrow_udf(starts, T.ArrayType(T.IntegerType()))(marked)


def _let(value: Column, then) -> Column:
    """What ``then`` makes of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _woven(texts: Column, token: str, gap: str) -> Column:
    """``(piece, end)`` of the tokens of several texts whose runs interleave."""
    cut = lambda t: F.regexp_extract_all(t, F.lit(f"({token}|{gap})"), F.lit(1))
    at_place = lambda cuts, i: F.array_compact(F.transform(cuts, lambda c: F.get(c, i)))
    weave = lambda cuts: F.flatten(F.transform(F.sequence(F.lit(0), F.array_max(F.transform(cuts, F.size))), lambda i: at_place(cuts, i)))
    blocks = lambda runs: F.transform(F.sequence(F.lit(1), F.greatest(F.size(runs), F.lit(1)), F.lit(BLOCK)), lambda at: F.slice(runs, at, BLOCK))
    last = lambda ends: F.element_at(ends, -1)
    begin = lambda begins, block: F.array_append(begins, last(begins) + F.char_length(F.array_join(block, "")))
    ends = lambda block, begin: F.slice(F.aggregate(block, F.array(begin), lambda e, p: F.array_append(e, last(e) + F.char_length(p))), 2, BLOCK)
    begins = lambda cut: F.aggregate(cut, F.array(F.lit(0)), begin)
    ended = lambda cut, begins: F.flatten(F.transform(cut, lambda b, i: F.arrays_zip(b.alias("piece"), ends(b, F.get(begins, i)).alias("end"))))
    every = _let(F.transform(texts, cut), lambda cuts: _let(weave(cuts), lambda runs: _let(blocks(runs), lambda b: _let(begins(b), lambda at: ended(b, at)))))
    return F.filter(every, lambda run: F.rlike(run["piece"], F.lit(f"^{token}")))


def placed(rows: DataFrame, key: str) -> DataFrame:
    """Rows placed by key, in as many partitions as the session names: adaptive execution would merge them by
    the size of the texts, and the tokens of a partition, many times larger, would no longer fit a task's memory."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def token_lists(docs: DataFrame, text: str, key: str = "doc_id", analyzer: str = "whitespace", late: bool = False) -> DataFrame:
    """``(key, _pieces, _starts)``: one row per key, its text cut at the marks, and where its tokens start.

    Every second piece is a token, or null where the analyzer drops a word.

    A mark is set before and behind each token. Offsets are added up inside the row, so no token row is sorted, shuffled or
    spilled; one row per document is placed by key, so later steps per document need no other
    shuffle. Documents of one key count as one whose runs interleave, and are held together. With ``late``, for lists that
    are stored, texts are moved before they are marked: neither marks nor offsets move, but Spark no longer knows
    where the rows lie.
    """
    fold, token, gap, dropped = RUNS[analyzer]
    text_ = F.col("_text")
    free = F.substring(F.call_function("translate", F.lit(SPARE), text_, F.lit("")), 1, 1)
    swap = F.when(F.contains(text_, F.lit(MARK)), F.coalesce(F.nullif(free, F.lit("")), F.raise_error(F.lit(NO_MARK))))
    plain = F.when(F.col("_swap").isNull(), text_).otherwise(F.replace(text_, F.lit(MARK), F.col("_swap")))
    marked = F.regexp_replace(fold(plain), F.lit(token), F.lit(f"{MARK}$0{MARK}"))

    def with_marks(rows: DataFrame, *carry: str) -> DataFrame:
        return (
            rows.select(*carry, "_text", swap.alias("_swap"))
            .select(*carry, "_swap", marked.alias("_marked"))
            .select(*carry, "_swap", "_marked", _starts(F.coalesce("_marked", F.lit(""))).alias("_starts"))
        )

    texts = docs.select(key, F.col(text).alias("_text"))
    back = lambda t, swap: F.when(swap.isNull(), t).otherwise(F.replace(t, swap, F.lit(MARK)))
    if late:
        of_key = placed(texts, key).groupBy(key).agg(F.collect_list("_text").alias("_texts"))
        several = F.size("_texts") > 1
        folded = F.when(several, F.array_sort(F.transform("_texts", fold))).alias("_folded")
        one = with_marks(of_key.select(key, several.alias("_several"), folded, F.when(~several, F.get("_texts", F.lit(0))).alias("_text")), key, "_several", "_folded")
    else:
        doc = F.when(F.col("_marked").isNotNull(), F.struct("_marked", "_starts", "_swap"))
        of_key = placed(with_marks(texts, key), key).groupBy(key).agg(F.collect_list(doc).alias("_docs"))
        several = F.size("_docs") > 1
        folded = F.array_sort(F.transform("_docs", lambda d: back(F.replace(d["_marked"], F.lit(MARK), F.lit("")), d["_swap"])))
        one = of_key.select(key, several.alias("_several"), F.when(several, folded).alias("_folded"), F.get("_docs", F.lit(0)).alias("_doc")).select(
            key, "_several", "_folded", "_doc._marked", "_doc._starts", "_doc._swap"
        )
    pieces = one.select(
        key, "_several", F.when(F.col("_several"), _woven(F.col("_folded"), token, gap)).alias("_words"), "_starts", "_swap", F.split("_marked", MARK).alias("_pieces")
    )
    alone = F.when(F.col("_swap").isNull(), F.col("_pieces")).otherwise(F.transform("_pieces", lambda p: back(p, F.col("_swap"))))
    words = F.flatten(F.transform("_words", lambda w: F.array(F.lit(""), w["piece"])))
    begins = F.transform("_words", lambda w: w["end"] - F.char_length(w["piece"]))
    all_pieces = F.when(F.col("_several"), words).otherwise(alone)
    if dropped:
        all_pieces = F.transform(all_pieces, lambda p: F.when(~p.isin(list(dropped)), p))
    return pieces.select(key, all_pieces.alias("_pieces"), F.when(F.col("_several"), begins).otherwise(F.col("_starts")).alias("_starts"))


def packed_lists(lists: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, _list)``: the words of ``token_lists`` as one text, without what lies between them, and where they start.

    No word is empty, so an empty one stands for a dropped word.
    """
    words = F.transform(F.filter("_pieces", lambda p, i: i % 2 == 1), lambda p: F.coalesce(p, F.lit("")))
    held = lists.select(key, "_starts", words.alias("_words")).select(key, "_starts", "_words", F.array_join("_words", "").alias("_text"))
    free = F.substring(F.call_function("translate", F.lit(SPARE), F.col("_text"), F.lit("")), 1, 1)
    joint = F.when(F.contains("_text", F.lit(MARK)), F.coalesce(F.nullif(free, F.lit("")), F.raise_error(F.lit(NO_MARK)))).otherwise(F.lit(MARK))
    joined = held.select(key, "_starts", "_words", joint.alias("joint"))
    text = F.call_function("array_join", F.col("_words"), F.col("joint"))
    return joined.select(key, F.struct(text.alias("words"), "joint", F.col("_starts").alias("starts")).alias("_list"))


def unpacked_words(of_list: Column) -> Column:
    """The words of a ``_list``, an empty one for each that was dropped."""
    return F.split(of_list["words"], of_list["joint"])


def token_rows(lists: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """The token table of ``token_lists``, a row per token, with the columns in ``carry``."""
    words = lists.select(key, "_starts", *carry, F.posexplode_outer("_pieces").alias("_run", "_piece")).filter((F.col("_run") % 2 == 1) & F.col("_piece").isNotNull())
    position = F.shiftright("_run", 1)
    start = F.get("_starts", position).cast("long")
    return words.select(
        key,
        F.col("_piece").alias("token"),
        position.alias("position"),
        F.lit(1).alias("position_length"),
        start.alias("start_offset"),
        (start + F.char_length("_piece")).alias("end_offset"),
        F.lit(WORD_TYPE).alias("type"),
        *carry,
    )


def token_table(docs: DataFrame, text: str, key: str = "doc_id", analyzer: str = "whitespace") -> DataFrame:
    """Tokens with positions and character offsets, for the analyzers of ``RUNS``.

    A word that the analyzer drops keeps its position, so the positions have a gap there.
    """
    return token_rows(token_lists(docs, text, key, analyzer), key)


def _span(position_length: str) -> Column:
    # A missing or zero length counts as one.
    return F.coalesce(F.nullif(F.col(position_length), F.lit(0)), F.lit(1))


def token_graph_nodes(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, node, index)``: every position a token starts or ends at, numbered from 0."""
    ends = F.array("position", F.col("position") + _span("position_length"))
    nodes = tokens.select(key, F.explode(ends).alias("node")).distinct()
    return nodes.withColumn("index", F.row_number().over(Window.partitionBy(key).orderBy("node")) - 1)


def token_graph_edges(
    tokens: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ("start_offset", "end_offset", "token")
) -> DataFrame:
    """``(key, token, src, dst, span, is_multi, parallel)``: one edge per token.

    ``parallel`` numbers the tokens between the same two nodes in the ``order`` of the tokens.
    """
    span = _span("position_length")
    edges = tokens.select(
        key,
        "token",
        F.col("position").alias("src"),
        (F.col("position") + span).alias("dst"),
        span.alias("span"),
        (span > 1).alias("is_multi"),
        F.struct(*order).alias("_order"),
    )
    same = Window.partitionBy(key, "src", "dst").orderBy("_order")
    return edges.withColumn("parallel", F.row_number().over(same) - 1).drop("_order")


def postings_and_lengths(
    docs: DataFrame, text: str, analyzer: str = "simple", key: str = "doc_id", terms: DataFrame | None = None
) -> DataFrame:
    """``(term, key, tf, doc_len)``: the postings, and for each document with any term a row of null term.

    Documents are placed by key before they are cut, so texts are moved and postings are not. With
    ``terms``, a stored frame of distinct terms, only their postings are counted, and nothing else is
    moved; documents and lengths stay those of whole texts.
    """
    docs = docs.select(key, F.col(text).alias("_text"))
    analyzed = (docs if terms is not None else placed(docs, key)).select(key, ANALYZERS[analyzer](F.col("_text")).alias("tokens")).select(
        key,
        F.size("tokens").cast("long").alias("doc_len"),
        F.when(F.size("tokens") > 0, F.array_append("tokens", F.lit(None).cast("string"))).alias("tokens"),
    )
    rows = analyzed.select(key, "doc_len", F.explode_outer("tokens").alias("term")).filter(F.col("doc_len") > 0)
    if terms is not None:
        # A common term, or the null of every document, is a large share of all rows.
        asked = terms.select("term", F.lit(True).alias("_asked"))
        rows = salted_join(rows, asked, ["term"], spread=[key]).filter(F.col("_asked") | F.col("term").isNull())
    return rows.groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"), F.max("doc_len").alias("doc_len"))


def build_postings(docs: DataFrame, text: str, analyzer: str = "simple", key: str = "doc_id") -> DataFrame:
    """``(term, key, tf, doc_len)``: the inverted index as a table."""
    return postings_and_lengths(docs, text, analyzer, key).filter(F.col("term").isNotNull())
