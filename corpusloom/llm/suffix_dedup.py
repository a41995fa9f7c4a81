"""Removal of repeated byte strings over a sparse suffix array.

A byte goes if a string of ``LENGTH`` bytes around it also starts elsewhere. Sorting every
suffix of the corpus would move each byte hundreds of times, so suffixes are taken only at
anchors: in each string of ``LENGTH`` bytes the leftmost ``GRAM``-byte string of least hash.
Equal strings have their anchor at the same place, so every repeat is found among suffixes
of anchors that recur. Those are range-partitioned at sampled splitters over their leading
``GRAM`` bytes and sorted in their bucket by multikey quicksort. Splitters are leading bytes,
so suffixes on two sides of a boundary differ within them and share no repeat. Repeats are read
off the sorted order: runs of neighbours that agree far enough to the right, and in a second
order, of what stands before the anchors, far enough to the left. An anchor whose leading bytes
are too common for one bucket is compared by hashes of its strings instead, dealt over all tasks.

Anchors with equal surroundings are one class: its members are repeats of each other as a
whole, and one stands for all in the comparison with the rest.

Repeats of a number of words are found in the same way, with the hash of a word in the place
of a byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing, materialize, text_key, text_or_empty
from corpusloom.session import salted_join, working_tables

by_value(__name__)

LENGTH = 400
GRAM = 128


class Unit(NamedTuple):
    """What a repeat is made of: its ``length``, the ``gram`` that an anchor starts with, and one unit's bytes when stored."""

    length: int
    gram: int
    width: int

    @property
    def reach(self) -> int:
        """Units to the left of an anchor that a string of ``length`` around it can reach."""
        return self.length - self.gram

    @property
    def kind(self) -> str:
        return f"<u{self.width}"


BYTES = Unit(LENGTH, GRAM, 1)
#: Words of an anchor; a repeat of so many words or fewer has anchors of a third of it.
GRAM_WORDS = 16
#: Suffixes of a bucket on average, and suffixes of equal leading bytes that one bucket takes.
BUCKET_ROWS = 8192
HOT_ROWS = 32768
#: Strings that start in this many bytes are searched for anchors at a time.
SEGMENT = 1 << 20
SMALL = 32
#: How many ways the classes of one gram are split.
GRAM_SALTS = 32
OUTPUT = ("n_bytes", "n_removed", "n_spans", "kept", "kept_text")

_RANDOM = np.random.default_rng(20250101)
_BYTE = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_ONE = np.uint64(1)


def word_unit(words: int) -> Unit:
    """Repeats of that many words."""
    return Unit(words, GRAM_WORDS if words > GRAM_WORDS else max(1, words // 3), 8)


def word_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, between ASCII white space."""
    full = np.frombuffer(data, dtype=np.uint8)
    full = np.concatenate(([False], (full != 32) & ((full < 9) | (full > 13)), [False]))
    edges = np.flatnonzero(full[1:] != full[:-1])
    return edges[::2], edges[1::2]


def units_of(text: str, unit: Unit) -> np.ndarray:
    """The bytes of a text, or XXH64 of its words."""
    data = text.encode()
    if unit.width == 1:
        return np.frombuffer(data, dtype=np.uint8)
    return np.array([xxhash.xxh64_intdigest(w) for w in data.split()], dtype="<u8")


def _value(which: int, data: np.ndarray) -> np.ndarray:
    """Numbers that stand for units in a polynomial hash."""
    return _BYTE[which][data] if data.dtype == np.uint8 else _mixed(data ^ _BYTE[which][0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = _ONE
    return np.cumprod(out)


class _Hashes:
    """Two polynomial hashes of substrings of one byte string, modulo 2**64 each."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray) -> None:
        need = 1 << (len(data) + 1).bit_length()
        if need not in self.tables:
            self.tables.clear()
            self.tables[need] = (
                np.stack([_powers(b, need) for b in _BASE]),
                np.stack([_powers(pow(b, -1, 2**64), need) for b in _BASE]),
            )
        self.power, self.inverse = self.tables[need]
        self.sums = np.zeros((2, len(data) + 1), dtype=np.uint64)
        for i in range(2):
            np.cumsum(_value(i, data) * self.power[i, : len(data)], out=self.sums[i, 1:])

    def of(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        return (sums[ends] - sums[starts]) * self.inverse[which][starts]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def find_anchors(data: np.ndarray, unit: Unit = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of the leading bytes, two hashes of the surroundings) of each anchor."""
    length, reach = unit.length, unit.reach
    places, grams, outer = [], [], []
    for start in range(0, len(data) - length + 1, SEGMENT):
        part = data[max(0, start - reach) : start + SEGMENT + length - 1 + length]
        skip = min(start, reach)
        hashes = _Hashes(part)
        at = np.arange(skip, min(skip + SEGMENT + reach, len(part) - unit.gram + 1))
        gram = _mixed(hashes.of(0, at, at + unit.gram))
        # The leftmost of equal least hashes: the low bits are the place.
        least = (gram & ~np.uint64(0x3FFFFF)) | np.arange(len(at), dtype=np.uint64)
        have = 1
        while have < reach + 1:
            step = min(have, reach + 1 - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        kept = np.unique(least & np.uint64(0x3FFFFF)).astype(np.int64)
        place = at[kept]
        low, high = np.maximum(place - reach, 0), np.minimum(place + length, len(part))
        size = (high - low).astype(np.uint64) << np.uint64(32) | (place - low).astype(np.uint64)
        places.append(place + start - skip)
        grams.append(gram[kept])
        outer.append([_mixed(hashes.of(i, low, high) + size) for i in range(2)])
    if not places:
        none = np.zeros(0, dtype=np.uint64)
        return np.zeros(0, dtype=np.int64), none, none, none
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, *(
        np.concatenate(x)[first] for x in (grams, [o[0] for o in outer], [o[1] for o in outer])
    )


def _anchors(text: Column, unit: Unit) -> Column:
    @F.pandas_udf("n int, place array<int>, gram array<long>, e1 array<long>, e2 array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            data = units_of(text, unit)
            place, *hashes = find_anchors(data, unit)
            rows.append([len(data), place.astype(np.int32), *(h.view(np.int64) for h in hashes)])
        return pd.DataFrame(rows, columns=["n", "place", "gram", "e1", "e2"])

    return of(text)


def _surroundings(batches: Iterator[pd.DataFrame], unit: Unit) -> Iterator[pd.DataFrame]:
    """The units around the wanted anchors of each text, as bytes."""
    reach, length, width = unit.reach, unit.length, unit.width
    for batch in batches:
        for id_, text, wanted in zip(batch["id"], batch["text"], batch["wanted"], strict=True):
            data = units_of(text, unit).tobytes()
            rows = [
                (
                    id_,
                    w["place"],
                    w["open"],
                    w["hot"],
                    min(w["place"], reach),
                    data[max(0, w["place"] - reach) * width : (w["place"] + length) * width],
                )
                for w in wanted
            ]
            frame = pd.DataFrame(rows, columns=["id", "place", "open", "hot", "left", "around"])
            yield frame


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of the rows of ``words`` (big-endian numbers as characters).

    Three-way partitioning on one character at a time; only the equal part moves on to the
    next character. Segments of a few rows are sorted directly.
    """
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        mine = order[low:high]
        if high - low <= SMALL:
            rest = words[mine, depth:]
            order[low:high] = mine[np.lexsort(rest.T[::-1])]
            continue
        character = words[mine, depth]
        pivot = np.partition(character, len(character) // 2)[len(character) // 2]
        less, more = mine[character < pivot], mine[character > pivot]
        same = mine[character == pivot]
        a, b = low + len(less), low + len(less) + len(same)
        order[low:a], order[a:b], order[b:high] = less, same, more
        todo += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _aligned(frame: pd.DataFrame, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, left, right): surroundings with the anchor in column ``reach``, filled up with zeros."""
    left = frame["left"].to_numpy().astype(np.int64)
    size = np.array([len(a) // unit.width for a in frame["around"]], dtype=np.int64)
    out = np.zeros((len(frame), unit.reach + unit.length), dtype=unit.kind)
    flat = np.frombuffer(b"".join(frame["around"]), dtype=unit.kind)
    row = np.repeat(np.arange(len(frame)), size)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(unit.reach - left, size)
    out[row, column] = flat
    return out, left, size - left


def _strings(data: np.ndarray, left: np.ndarray, right: np.ndarray, unit: Unit) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each distance of a string's start from its anchor: rows that have it, and two hashes."""
    length, reach = unit.length, unit.reach
    power = [_powers(b, length) for b in _BASE]
    now = []
    for i in range(2):
        total = np.zeros(len(data), dtype=np.uint64)
        for j in range(length):
            total += _value(i, data[:, reach + j]) * power[i][j]
        now.append(total)
    for d in range(reach + 1):
        yield d, (left >= d) & (right >= length - d), np.stack(now)
        if d < reach:
            for i in range(2):
                gone = _value(i, data[:, reach + length - 1 - d]) * power[i][-1]
                now[i] = _value(i, data[:, reach - 1 - d]) + np.uint64(_BASE[i]) * (now[i] - gone)


def _sorted(units: np.ndarray) -> np.ndarray:
    """The order of rows of units, by multikey quicksort on eight bytes at a time."""
    raw = np.ascontiguousarray(units).view(np.uint8).reshape(len(units), -1)
    if units.dtype.itemsize == 8:
        return multikey_quicksort(units)
    return multikey_quicksort(np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view(">u8").astype(np.uint64))


def _common(rows: np.ndarray) -> np.ndarray:
    """How many leading units each row shares with the one before it."""
    same = rows[1:] == rows[:-1]
    out = np.zeros(len(rows), dtype=np.int64)
    out[1:] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1)) if rows.shape[1] else 0
    return out


def _repeats(frame: pd.DataFrame, unit: Unit) -> pd.DataFrame:
    """Starts of repeated strings around the open anchors of one bucket, as ranges.

    Suffixes are sorted to the right of their anchors, and what stands before the anchors is sorted
    backwards. Rows that agree in so many units to one side stand together in that order, between
    neighbours that have less in common. A string that starts ``d`` units before its anchor recurs if
    another row is in the same run on both sides: for ``length - d`` units and for ``d``.
    """
    data, left, right = _aligned(frame, unit)
    order = _sorted(data[:, unit.reach :])
    joined = _common(data[order, unit.reach :]) >= unit.gram
    order = order[joined | np.append(joined[1:], False)]  # the others share no leading units with any
    data, left, right = data[order], left[order], right[order]
    after, before = _common(data[:, unit.reach :]), np.ascontiguousarray(data[:, : unit.reach][:, ::-1])
    backwards = _sorted(before)
    common_before = _common(before[backwards])
    repeated = np.zeros((len(order), unit.reach + 2), dtype=bool)
    run_before = np.zeros(len(order), dtype=np.int64)
    for d in range(unit.reach + 1):
        run_before[backwards] = np.cumsum(common_before < d)
        rows = np.flatnonzero((left >= d) & (right >= unit.length - d))
        run = np.cumsum(after < unit.length - d)[rows] * (len(order) + 1) + run_before[rows]
        by = np.argsort(run, kind="stable")
        same = run[by][1:] == run[by][:-1]
        hit = np.zeros(len(rows), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        repeated[rows[by[hit]], d] = True
    repeated &= frame["open"].to_numpy()[order][:, None]
    edges = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    row, first = np.nonzero(edges == 1)
    last = np.nonzero(edges == -1)[1] - 1
    id_, place = frame["id"].to_numpy()[order][row], frame["place"].to_numpy()[order][row].astype(np.int64)
    return pd.DataFrame({"id": id_, "low": place - last, "high": place - first + unit.length})


def _bucket(batches: Iterator[pd.DataFrame], unit: Unit) -> Iterator[pd.DataFrame]:
    held = [b for b in batches if len(b)]
    if held:
        yield _repeats(pd.concat(held, ignore_index=True), unit)


def _hot_strings(batches: Iterator[pd.DataFrame], unit: Unit) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        data, left, right = _aligned(batch, unit)
        for d, valid, (h1, h2) in _strings(data, left, right, unit):
            rows = np.flatnonzero(valid)
            yield pd.DataFrame(
                {
                    "d": d,
                    "h1": h1[rows].view(np.int64),
                    "h2": h2[rows].view(np.int64),
                    "open": batch["open"].to_numpy()[rows],
                    "id": batch["id"].to_numpy()[rows],
                    "low": batch["place"].to_numpy()[rows].astype(np.int64) - d,
                }
            )


def _wordy(text: Column, words: int) -> Column:
    """Whether a string of ``LENGTH`` bytes of the text may hold fewer than that many whole words."""

    @F.pandas_udf("boolean")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            data = text.encode()
            starts, ends = word_ranges(data)
            # The widest strings that cut two words, or end with the text, and have words - 1 between.
            starts, ends = np.append(-1, starts), np.append(ends, len(data) + 1)
            last = np.minimum(np.arange(len(starts)) + words - 1, len(ends) - 1)
            out.append(bool((ends[last] - starts - 2 >= LENGTH).any()))
        return pd.Series(out, dtype=bool)

    return of(text)


def _cut(text: Column, spans: Column, passages: Column) -> Column:
    """What stays of a text without ``spans`` of bytes and ``passages`` of words; a passage goes up to the next word."""

    @F.pandas_udf("kept binary, n_spans int, kept_text string")
    def of(texts: pd.Series, spans: pd.Series, passages: pd.Series) -> pd.DataFrame:
        out = []
        for text, found, worded in zip(texts, spans, passages, strict=True):
            if found is None and worded is None:
                out.append((None, 0, None))
                continue
            data, kept, at, runs = text.encode(), [], 0, 0
            ranges = [(s["low"], s["high"]) for s in found] if found is not None else []
            if worded is not None:
                starts = np.append(word_ranges(data)[0], len(data)).tolist()
                ranges += [(starts[s["low"]], starts[s["high"]]) for s in worded]
            for low, high in sorted(ranges):
                if low > at or runs == 0:
                    kept.append(data[at:low])
                    runs += 1
                at = max(at, high)
            kept.append(data[at:])
            out.append((b"".join(kept), runs, "".join(run.decode(errors="ignore") for run in kept)))
        return pd.DataFrame(out, columns=["kept", "n_spans", "kept_text"])

    return of(text, spans, passages)


def repeated_spans(
    docs: DataFrame, text: str = "text", bucket_rows: int = BUCKET_ROWS, hot_rows: int = HOT_ROWS, unit: Unit = BYTES
) -> DataFrame:
    """(key, spans): ranges [low, high) of repeats, in units, per distinct text that has any.

    ``key`` is the text's key. Ranges may overlap. Null counts as the empty text. Only the ranges stay
    stored: the tables they are made from, larger than all texts in parts, go before the texts are cut.
    """
    with working_tables(docs.sparkSession) as store:
        return materialize(_spans(docs, text, bucket_rows, hot_rows, unit, store), "spans")


def _spans(
    docs: DataFrame, text: str, bucket_rows: int, hot_rows: int, unit: Unit, store: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    found = store(
        docs.select(text_key(text).alias("key"), text_or_empty(text).alias("text")).select(
            F.monotonically_increasing_id().alias("id"),
            "key",
            _anchors(F.col("text"), unit).alias("found"),
        ),
        "anchors",
    ).withColumn("n_units", F.col("found.n"))
    texts = found.groupBy("key", "n_units").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    anchors = found.select(
        "id", "n_units", F.explode(F.arrays_zip("found.place", "found.gram", "found.e1", "found.e2")).alias("a")
    ).select("id", "n_units", "a.*")
    recurring = anchors.groupBy("gram").count().filter(F.col("count") > 1).select("gram")
    single = texts.select("id")
    # One gram may hold a large share of all anchors: that of a passage in very many texts.
    often = salted_join(anchors, recurring, ["gram"], spread=["id", "place"], how="left_semi")
    recurring_anchors = store(often.join(single, "id", "left_semi"), "recurring")
    classes = recurring_anchors.groupBy("gram", "e1", "e2").agg(
        F.count("*").alias("members"), F.min(F.struct("id", "place")).alias("one")
    )
    shared = classes.filter(F.col("members") > 1).select("gram", "e1", "e2")
    whole = salted_join(recurring_anchors, shared, ["gram", "e1", "e2"], spread=["id", "place"], how="left_semi").select(
        "id",
        F.greatest(F.col("place") - unit.reach, F.lit(0)).cast("long").alias("low"),
        F.least(F.col("place") + unit.length, F.col("n_units")).cast("long").alias("high"),
    )
    contested = classes.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    wanted = (
        salted_join(classes, contested, ["gram"], spread=["one"], how="inner", salts=GRAM_SALTS)
        .select("one.id", F.struct(F.col("one.place").alias("place"), (F.col("members") == 1).alias("open"), (F.col("n") > hot_rows).alias("hot")).alias("w"))
        .groupBy("id")
        .agg(F.collect_list("w").alias("wanted"))
        .join(texts.select("id", "key"), "id")
    )
    placed = docs.select(
        text_key(text).alias("key"), text_or_empty(text).alias("text"), F.monotonically_increasing_id().alias("place")
    )
    # Copies of one text are spread, and are one row per task before they meet.
    around = store(
        salted_join(placed, wanted, ["key"], spread=["place"], how="inner")
        .groupBy("key")
        .agg(F.first("id").alias("id"), F.first("text").alias("text"), F.first("wanted").alias("wanted"))
        .select("id", "text", "wanted")
        .mapInPandas(lambda batches: _surroundings(batches, unit), "id long, place int, open boolean, hot boolean, left int, around binary"),
        "surroundings",
    )
    sizes = {r.hot: r.n for r in around.groupBy("hot").agg(F.count("*").alias("n")).collect()}
    suffix = F.substring("around", F.col("left") * unit.width + 1, F.lit(unit.gram * unit.width))
    ranges = (
        around.filter(~F.col("hot"))
        .withColumn("lead", suffix)
        .repartitionByRange(max(1, -(-sizes.get(False, 0) // bucket_rows)), "lead")
        .drop("lead", "hot")
        .mapInPandas(lambda batches: _bucket(batches, unit), "id long, low long, high long")
    )
    if sizes.get(True):
        strings = store(
            around.filter("hot").drop("hot").mapInPandas(
                lambda batches: _hot_strings(batches, unit), "d int, h1 long, h2 long, open boolean, id long, low long"
            ),
            "hot-strings",
        )
        known = strings.groupBy("d", "h1", "h2").count().filter(F.col("count") > 1).select("d", "h1", "h2")
        ranges = ranges.unionByName(
            strings.filter("open").join(known, ["d", "h1", "h2"], "left_semi").select("id", "low", (F.col("low") + unit.length).alias("high"))
        )
    spans = whole.unionByName(ranges).groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("n_units").cast("long").alias("high")))
    return (
        texts.join(spans, "id", "left")
        .select("key", F.when((F.col("copies") > 1) & (F.col("n_units") >= unit.length), everything).otherwise(F.col("spans")).alias("spans"))
        .filter(F.col("spans").isNotNull())
    )


def remove_repeats(docs: DataFrame, text: str = "text", words: int | None = None, **limits: int) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, ``kept`` (bytes that stay) and ``kept_text`` added.

    Every byte inside a string of ``LENGTH`` bytes that starts at another place too, in any
    document, is removed; all places are judged on the input. Texts that are copies of each
    other repeat as a whole from ``LENGTH`` bytes on. Null counts as empty; shorter texts only
    stay. Bytes are cut without regard to characters: ``kept`` need not be valid UTF-8;
    ``kept_text`` is without the characters that were cut through. Input columns named like an
    added one are replaced.

    With ``words`` every passage of that many words that stands elsewhere too is removed, however
    few bytes it has and whatever white space separates it. Strings of ``LENGTH`` bytes then are
    compared only in texts where one may hold fewer words than that: a repeat of ``LENGTH`` bytes
    with as many whole words goes as a passage.
    """
    rows = drop_clashing(docs, *OUTPUT)
    keyed = rows.withColumns({"__op_key": text_key(text), "__op_place": F.monotonically_increasing_id()})
    whole = text_or_empty(text)
    strings = docs if words is None else docs.filter(_wordy(whole, words))
    spans = repeated_spans(strings, text, **limits).select(F.col("key").alias("__op_key"), F.col("spans").alias("__op_spans"))
    if words is None:
        spans = spans.withColumn("__op_passages", F.lit(None).cast(spans.schema["__op_spans"].dataType))
    else:
        passages = repeated_spans(docs, text, unit=word_unit(words), **limits)
        spans = spans.join(
            passages.select(F.col("key").alias("__op_key"), F.col("spans").alias("__op_passages")), "__op_key", "full"
        )
    joined = salted_join(keyed, spans, ["__op_key"], spread=["__op_place"]).withColumn(
        "__op_cut",
        _cut(F.when(F.coalesce("__op_spans", "__op_passages").isNotNull(), whole), F.col("__op_spans"), F.col("__op_passages")),
    )
    kept = F.coalesce(F.col("__op_cut.kept"), whole.cast("binary"))
    return joined.select(
        *(F.col(f"`{c}`") for c in rows.columns),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        (F.octet_length(whole) - F.octet_length(kept)).cast("long").alias("n_removed"),
        F.col("__op_cut.n_spans").cast("long").alias("n_spans"),
        kept.alias("kept"),
        F.coalesce(F.col("__op_cut.kept_text"), whole).alias("kept_text"),
    )
