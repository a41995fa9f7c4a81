"""Segmentation of Japanese text: a word lattice per run, cut by Viterbi over a unigram lexicon.

The lexicon is counted from the corpus itself: every substring of up to ``LONGEST`` characters of
every Japanese run. A substring is a word if it is one character or occurs often enough; its cost
is the negative logarithm of its share of all characters, in whole thousandths. The cheapest
way through the lattice of a run's words is its segmentation; of equally cheap ways the one with
the longer last word, seen from the end, is taken.

Runs repeat, so lattices are built and cut once per distinct run, in built-in expressions.
Forward costs need the last few positions only. Positions are handled in blocks, whose results
are appended block by block, so that a very long run costs no square of its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import analysis as an
from corpusloom.operators.tokens import MARK, _let, placed
from corpusloom.session import materialize, salted_join

#: Characters of a word at most, and how often a word of several must occur.
LONGEST = 4
MIN_COUNT = 3
#: Distinct runs, the most frequent ones, whose words every task holds, and characters of such a run at most.
FREQUENT = 20000
FREQUENT_LENGTH = 64
#: Characters of a run whose ends are held as ASCII characters.
SHORT = 64
#: Positions that are handled before their results are appended.
BLOCK = 128

_GAP = rf"[^\p{{L}}\p{{N}}{an.HAN}{an.HIRAGANA}{an.KATAKANA}]+"
_JAPANESE = f"^{an.CJK}"


def _woven(texts: Column) -> Column:
    """(piece, gap) of several texts whose runs interleave; a gap is the number of characters since the piece before."""
    cut = lambda t: F.regexp_extract_all(t, F.lit(f"({an.CJK}+|{an.OTHER_WORD}|{_GAP})"), F.lit(1))
    at_place = lambda cuts, i: F.array_compact(F.transform(cuts, lambda c: F.get(c, i)))
    weave = lambda cuts: F.flatten(F.transform(F.sequence(F.lit(0), F.array_max(F.transform(cuts, F.size))), lambda i: at_place(cuts, i)))
    blank = lambda p: F.rlike(p, F.lit(f"^{_GAP}"))
    none = F.struct(F.lit(0).alias("gap"), F.lit(None).cast("string").alias("piece"))

    def step(state: Column, piece: Column) -> Column:
        since = F.when(state["piece"].isNull(), state["gap"]).otherwise(0)
        return F.when(blank(piece), F.struct((since + F.char_length(piece)).alias("gap"), F.lit(None).cast("string").alias("piece"))).otherwise(
            F.struct(since.alias("gap"), piece.alias("piece"))
        )

    found = F.filter(_scan(_let(F.transform(texts, cut), weave), none, step, lambda s: s, "struct<gap:int,piece:string>"), lambda s: s["piece"].isNotNull())
    return F.transform(found, lambda s: F.struct(s["piece"].alias("piece"), s["gap"].alias("gap")))


def piece_lists(docs: DataFrame, text: str, key: str = "doc_id") -> DataFrame:
    """``(key, pieces)``: one row per key, its Japanese runs and other words as (piece, gap).

    A gap is the number of characters since the piece before. Documents of one key count as one whose
    runs interleave, and are held together.
    """
    # Every character is of a run, a word or a gap, so a match ends in a piece, or in nothing at the end of the text.
    pattern = F.lit(f"({_GAP}+)?+({an.CJK}+|{an.OTHER_WORD}|\\z)")
    of_key = placed(docs.select(key, F.col(text).alias("_text")), key).groupBy(key).agg(F.collect_list("_text").alias("_texts"))
    one = F.get("_texts", F.lit(0))
    found = F.zip_with(
        F.regexp_extract_all(one, pattern, F.lit(2)), F.regexp_extract_all(one, pattern, F.lit(1)), lambda p, g: F.struct(p.alias("piece"), F.char_length(g).alias("gap"))
    )
    alone = F.filter(found, lambda p: p["piece"] != "")
    return of_key.select(key, F.when(F.size("_texts") > 1, _woven(F.sort_array("_texts"))).otherwise(alone).alias("pieces"))


def pieces(docs: DataFrame, text: str, key: str = "doc_id") -> DataFrame:
    """``(key, run, piece, start_offset)``: Japanese runs and other words, without what lies between; gaps are counted as runs."""
    rows = piece_lists(docs, text, key).select(key, F.posexplode("pieces").alias("at", "p")).select(key, "at", "p.piece", "p.gap")
    so_far = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.char_length("piece")
    run = (F.sum((F.col("gap") > 0).cast("int") + 1).over(so_far) - 1).cast("int")
    return rows.select(key, run.alias("run"), "piece", (F.sum(F.col("gap") + length).over(so_far) - length).alias("start_offset"))


def _substrings(run: Column, longest: int) -> Column:
    """(end, length, word) of every substring of up to ``longest`` characters."""
    size = F.char_length(run)
    at = lambda end, n: F.struct(end.alias("end"), n.alias("length"), F.substring(run, end - n + 1, n).alias("word"))
    of_end = lambda end: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), end)), lambda n: at(end, n))
    return F.flatten(F.transform(F.sequence(F.lit(1), size), of_end))


def count_lexicon(runs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n, cost)`` from distinct ``(piece, n)`` runs.

    Substrings are counted before they are shuffled. The cost is
    ``floor(1000 * ln(characters / n))``, so a word beats its parts if it occurs more often
    than chance would bring them together.
    """
    total = runs.agg(F.sum(F.col("n") * F.char_length("piece")).alias("total")).select("total").scalar()
    words = runs.select("n", F.explode(F.transform(_substrings(F.col("piece"), longest), lambda s: s.word)).alias("word"))
    counted = words.groupBy("word").agg(F.sum("n").alias("n"))
    kept = counted.filter((F.char_length("word") == 1) | (F.col("n") >= min_count))
    return kept.select("word", "n", F.floor(1000 * F.ln(total / F.col("n"))).alias("cost"))


def _scan(items: Column, state: Column, step: Callable[[Column, Column], Column], out: Callable[[Column], Column], kind: str) -> Column:
    """What ``out`` makes of each state while ``step`` takes it over the items; results are appended block by block."""
    none = F.array().cast(f"array<{kind}>")

    def one(held: Column, item: Column) -> Column:
        after = F.transform(F.array(step(held["state"], item)), lambda s: F.struct(s.alias("state"), F.array_append(held["outs"], out(s)).alias("outs")))
        return after[0]

    def block(held: Column, items: Column) -> Column:
        done = F.aggregate(items, F.struct(held["state"].alias("state"), none.alias("outs")), one)
        return F.transform(F.array(done), lambda d: F.struct(d["state"].alias("state"), F.array_append(held["outs"], d["outs"]).alias("outs")))[0]

    starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.slice(items, at, BLOCK))
    start = F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("outs"))
    return F.flatten(F.aggregate(blocks, start, block)["outs"])


def _best_ends(costs: Column, longest: int) -> Column:
    """For each position the length of the last word of the cheapest way there."""
    names = [f"c{k}" for k in range(1, longest + 1)]
    first = F.struct(F.lit(0).cast("long").alias("c1"), *(F.lit(None).cast("long").alias(n) for n in names[1:]), F.lit(0).alias("last"))

    def step(state: Column, options: Column) -> Column:
        ways = [state[n] + options[n] for n in names]
        best = F.least(*ways) if longest > 1 else ways[0]
        last = F.coalesce(*(F.when(ways[k - 1] == best, F.lit(k)) for k in range(longest, 0, -1)))
        return F.struct(best.alias("c1"), *(state[a].alias(b) for a, b in zip(names, names[1:], strict=False)), last.alias("last"))

    return _scan(costs, first, step, lambda state: state["last"], "int")


def _word_ends(last: Column) -> Column:
    """(end, length) of the words that a list of last lengths leads back to, from the start."""
    items = F.reverse(F.transform(last, lambda n, i: F.struct((i + 1).alias("end"), n.alias("length"))))
    first = F.struct(F.size(last).alias("next"), F.lit(0).alias("end"), F.lit(0).alias("length"))

    def step(state: Column, item: Column) -> Column:
        here = item["end"] == state["next"]
        return F.struct(
            F.when(here, item["end"] - item["length"]).otherwise(state["next"]).alias("next"),
            F.when(here, item["end"]).otherwise(0).alias("end"),
            F.when(here, item["length"]).otherwise(0).alias("length"),
        )

    marks = _scan(items, first, step, lambda s: F.struct(s["end"].alias("end"), s["length"].alias("length")), "struct<end:int,length:int>")
    return F.reverse(F.filter(marks, lambda m: m["length"] > 0))


def _short_words(costs: Column, longest: int) -> Column:
    """The words of a run of up to ``SHORT`` characters, in one scan: a way is held as the text of its words' ends."""
    big = F.lit(2**62).cast("long")
    first = F.struct(
        *(F.lit(0 if k == 1 else None).cast("long").alias(f"c{k}") for k in range(1, longest + 1)),
        *(F.lit("" if k == 1 else None).cast("string").alias(f"p{k}") for k in range(1, longest + 1)),
    )

    def step(state: Column, options: Column) -> Column:
        ways = F.array(*(F.struct(F.coalesce(state[f"c{k}"] + options[f"c{k}"], big).alias("cost"), F.lit(-k).alias("back")) for k in range(1, longest + 1)))
        way = lambda best: F.concat(F.elt(-best["back"], *(state[f"p{k}"] for k in range(1, longest + 1))), F.char(options["end"] + 32))
        after = lambda best: F.struct(
            best["cost"].alias("c1"),
            *(state[f"c{k}"].alias(f"c{k + 1}") for k in range(1, longest)),
            way(best).alias("p1"),
            *(state[f"p{k}"].alias(f"p{k + 1}") for k in range(1, longest)),
        )
        return _let(F.array_min(ways), after)

    path = F.aggregate(costs, first, step)["p1"]
    end = lambda path, i: F.ascii(F.substring(path, i, 1)) - 32
    word = lambda path, i: F.struct(end(path, i).alias("end"), (end(path, i) - F.when(i > 1, end(path, i - 1)).otherwise(0)).alias("length"))
    return _let(path, lambda path: F.transform(F.sequence(F.lit(1), F.char_length(path)), lambda i: word(path, i)))


def segment_runs(runs: DataFrame, lexicon: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(piece, words)``: for each distinct run its words as (end, length), in order.

    A character that the lexicon lacks costs more than any word that it holds.
    """
    unknown = lexicon.agg((F.max("cost") + 1000).alias("cost")).select("cost").scalar()
    stored = materialize(runs.select("piece", F.monotonically_increasing_id().alias("id")), "numbered-runs")
    every = stored.select("id", F.explode(_substrings(F.col("piece"), longest)).alias("s")).select("id", "s.*")
    # One word may be in a large share of all runs.
    priced = salted_join(every, lexicon.select("word", "cost"), ["word"], spread=["id", "end"])
    cost = F.coalesce("cost", F.when(F.col("length") == 1, F.coalesce(unknown, F.lit(0))))
    # What is no word is not moved, and a run is moved once; all that follows is of rows placed by run.
    words = priced.select("id", "end", "length", cost.alias("cost")).filter(F.col("cost").isNotNull()).repartition("id")
    options = words.groupBy("id", "end").agg(*(F.max(F.when(F.col("length") == k, F.col("cost"))).alias(f"c{k}") for k in range(1, longest + 1)))
    costs = F.struct("end", *(f"c{k}" for k in range(1, longest + 1)))
    listed = options.groupBy("id").agg(F.sort_array(F.collect_list(costs)).alias("costs"))
    words = F.when(F.size("costs") <= SHORT, _short_words(F.col("costs"), longest)).otherwise(_word_ends(_best_ends(F.col("costs"), longest)))
    return listed.join(stored, "id").select("piece", words.alias("words"))


def segment_corpus(
    docs: DataFrame, text: str, key: str = "doc_id", lexicon: DataFrame | None = None, longest: int = LONGEST, min_count: int = MIN_COUNT
) -> DataFrame:
    """Token table of Japanese texts: ``(key, token, position, position_length, start_offset, end_offset, type)``.

    Words of other scripts stay whole. Without a ``lexicon`` (word, cost) one is counted from ``docs``.
    """
    cut = materialize(piece_lists(docs, text, key), "pieces", "zstd")
    single = cut.select(key, F.posexplode("pieces").alias("at", "p")).select(key, "at", "p.piece")
    japanese = single.filter(F.rlike("piece", F.lit(_JAPANESE)))
    runs = materialize(japanese.groupBy("piece").agg(F.count("*").alias("n")), "runs")
    known = materialize(count_lexicon(runs, longest, min_count) if lexicon is None else lexicon, "lexicon")
    # A run's words are told by their ends.
    ends = F.transform("words", lambda w: w["end"]).alias("ends")
    words = materialize(segment_runs(runs, known, longest).select("piece", ends), "segmented")
    # Most pieces are one of a bounded number of frequent runs, whose words every task holds. Only the others move.
    short = runs.filter(F.char_length("piece") <= FREQUENT_LENGTH)
    by_count = short.groupBy("n").agg(F.count("*").alias("runs"))
    up_to = by_count.select("n", F.sum("runs").over(Window.orderBy(F.desc("n"))).alias("up_to"))
    least = up_to.filter(F.col("up_to") <= FREQUENT).agg(F.min("n").alias("least")).select("least").scalar()
    frequent = materialize(words.join(short.filter(F.col("n") >= least).select("piece"), "piece", "left_semi"), "frequent")
    rare = japanese.join(F.broadcast(frequent.select("piece")), "piece", "left_anti").join(words, "piece")
    found = F.struct("at", "ends").alias("found")
    # The pieces of a document move as one text: none holds the mark.
    listed = F.struct(F.array_join(F.col("pieces.piece"), MARK).alias("text"), F.col("pieces.gap").alias("gaps"))
    of_doc, of_rare = cut.filter(F.size("pieces") > 0).select(key, listed.alias("listed")), rare.select(key, found)
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    both = of_doc.select(key, "listed", none(of_rare, "found")).unionByName(of_rare.select(key, none(of_doc, "listed"), "found"))
    of_key = placed(both, key).groupBy(key).agg(F.first("listed", ignorenulls=True).alias("listed"), F.sort_array(F.collect_list("found")).alias("found"))
    # The words of the rare runs at their places, with nulls between.
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get("found", i - 1)["at"])
    no_words = F.lit(None).cast(words.schema["ends"].dataType)
    aligned = F.flatten(F.transform("found", lambda f, i: F.concat(F.array_repeat(no_words, f["at"] - before(i) - 1), F.array(f["ends"]))))
    rows = (
        of_key.select(key, "listed.gaps", F.split("listed.text", MARK).alias("pieces"), aligned.alias("own"))
        .select(key, "gaps", "own", F.posexplode("pieces").alias("at", "piece"))
        .select(key, "at", "piece", F.get("gaps", F.col("at")).alias("gap"), F.get("own", F.col("at")).alias("own"))
        .join(F.broadcast(frequent), "piece", "left")
    )
    with_words = rows.select(key, "at", "piece", "gap", F.coalesce("own", "ends", F.array(F.char_length("piece"))).alias("ends"))
    so_far = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.char_length("piece")
    begin = F.sum(F.col("gap") + length).over(so_far) - length
    first = F.sum(F.size("ends")).over(so_far) - F.size("ends")
    tokens = (
        with_words.select(key, "piece", begin.alias("start"), first.cast("int").alias("first"), "ends")
        .select(key, "piece", "start", "first", "ends", F.posexplode("ends").alias("nth", "end"))
        .select(key, "piece", "start", "first", "nth", F.struct("end", (F.col("end") - F.coalesce(F.get("ends", F.col("nth") - 1), F.lit(0))).alias("length")).alias("w"))
    )
    start = F.col("start") + F.col("w.end") - F.col("w.length")
    return tokens.select(
        key,
        F.substring(F.col("piece"), F.col("w.end") - F.col("w.length") + 1, F.col("w.length")).alias("token"),
        (F.col("first") + F.col("nth")).alias("position"),
        F.lit(1).alias("position_length"),
        start.alias("start_offset"),
        (start + F.col("w.length")).alias("end_offset"),
        F.lit("word").alias("type"),
    )


def filter_japanese(tokens: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """The filters that follow the tokenizer: width, stop words, katakana stem, lower case; dropped words leave a gap."""
    stop = an.JAPANESE_STOP_WORDS if stop_words is None else stop_words
    kept = tokens.withColumn("token", an.width_fold(F.col("token"))).filter(~F.col("token").isin(stop))
    stemmed = F.regexp_replace("token", "^([ァ-ヺー]{3,})ー$", "$1")
    return kept.withColumn("token", an.lower_text(stemmed))
