"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. By the triangle inequality on the
sphere the angle between two rows is at least the difference of their angles to any reference
and at most their sum, so a cosine lies in a known interval; times the norms that bounds the
score from both sides, widened by what rounding may cost. Rows are laid out by label and by
nearest reference, in blocks and in tiles of a block, which carry the intervals of their rows'
angles and norms. Only blocks and tiles whose score bounds overlap a window that is searched get
scored, by exact integer inner products: first for the positives, whose window begins at the
least positive found so far, then for the negatives in the windows that the positives set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.common import by_value, materialize

by_value(__name__)

SCALE = 256
#: Reference directions, and the rows they are chosen from: those of the least hashes.
REFERENCES, SAMPLE = 16, 512
#: Rows of a block, anchors of a block, rows of a tile.
ROWS, ANCHORS, TILE = 4096, 1024, 128
#: What rounding may change about an angle, and about a score in relation to the product of the norms.
ANGLE_ROUNDING, SCORE_ROUNDING = 1e-6, 1e-9
#: Products of norms up to here have inner products that doubles hold exactly.
EXACT = 2.0**52
LONGEST = 2**63 - 1
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# --- references and angles ------------------------------------------------------------------


def _matrix(vectors: list, dims: int = 0) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    out = np.zeros((len(vectors), max([dims, *(len(v) for v in vectors)])))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _lengths(rows: np.ndarray) -> np.ndarray:
    most = np.abs(rows).max(axis=1, initial=0)
    scaled = rows / np.where(most > 0, most, 1)[:, None]
    return most * np.sqrt((scaled**2).sum(axis=1))


def references(sample: np.ndarray) -> np.ndarray:
    """Directions of the sample that lie far from one another, taken greedily."""
    norms = _lengths(sample)
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return units
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(REFERENCES, len(units)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of rows to directions; a zero row stands at a right angle to all."""
    width = max(rows.shape[1], directions.shape[1])
    rows, directions = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, directions))
    norms = _lengths(rows)
    return np.arccos(np.clip(rows / np.where(norms > 0, norms, 1)[:, None] @ directions.T, -1, 1))


def _with_angles(batches: Iterator[pd.DataFrame], directions: np.ndarray) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = _matrix(batch["vector"].to_list())
        angles = angles_to(rows, directions)
        close = angles.argmin(axis=1) if angles.size else np.zeros(len(rows), dtype=int)
        least = angles.min(axis=1) if angles.size else np.zeros(len(rows))
        yield batch.assign(norm=_lengths(rows), angles=list(angles), close=close.astype(np.int32), least=least)


# --- blocks ---------------------------------------------------------------------------------


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` in the order of label, nearest reference and angle, with the number of their ``block`` of ``size`` rows.

    Partitions are sorted by themselves; how many rows the ones before hold makes a row's place in the
    whole. That is one number a partition.
    """
    order = ["label", "close", "least", "row"]
    placed = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}),
        name,
    )
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("place")
    numbered = placed.join(offsets, "part").select(
        *rows.columns, place.alias("place"), F.floor(place / size).cast("long").alias("block")
    )
    return materialize(numbered, name)


def _summary(blocks: DataFrame, n_angles: int, *more: Column) -> DataFrame:
    """One row per block: the intervals of its rows' labels, norms and angles."""
    return blocks.groupBy("block").agg(
        F.min("label").alias("label_from"),
        F.max("label").alias("label_to"),
        F.min("norm").alias("norm_from"),
        F.max("norm").alias("norm_to"),
        F.array(*(F.min(F.col("angles")[i]) for i in range(n_angles))).cast("array<double>").alias("from"),
        F.array(*(F.max(F.col("angles")[i]) for i in range(n_angles))).cast("array<double>").alias("to"),
        *more,
    )


def _pairs(rows: DataFrame, anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Summaries of all rows' blocks (r) beside those of all blocks of anchors (a), in one line each."""
    left = rows.select(F.struct("*").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")).alias("block"))
    return left.join(anchors.select(F.struct("*").alias("a"), "block"), "block").select("r", "a")


def _bounded(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the ``least`` and ``most`` score that rows of the blocks ``r`` and ``a`` can have."""
    gap = lambda x, y: F.coalesce(F.array_max(F.zip_with(x, y, lambda p, q: p - q)), F.lit(0.0))
    reach = F.coalesce(F.array_min(F.zip_with("a.to", "r.to", lambda p, q: p + q)), F.lit(np.pi))
    around = F.coalesce(F.array_min(F.zip_with("a.from", "r.from", lambda p, q: 2 * np.pi - p - q)), F.lit(np.pi))
    near = F.greatest(F.lit(0.0), F.greatest(gap("a.from", "r.to"), gap("r.from", "a.to")) - ANGLE_ROUNDING)
    far = F.least(F.lit(np.pi), F.least(reach, around) + ANGLE_ROUNDING)
    most, least = F.col("a.norm_to") * F.col("r.norm_to"), F.col("a.norm_from") * F.col("r.norm_from")
    slack = SCORE_ROUNDING * most + 1
    return (
        pairs.withColumns({"highest": F.cos(near), "lowest": F.cos(far)})
        .withColumn("least", F.col("lowest") * F.when(F.col("lowest") < 0, most).otherwise(least) - slack)
        .withColumn("most", F.col("highest") * F.when(F.col("highest") > 0, most).otherwise(least) + slack)
    )


# --- scoring --------------------------------------------------------------------------------


class _Side:
    """Rows of one block as arrays, cut into tiles of ``tile`` rows."""

    def __init__(self, frame: pd.DataFrame, tile: int) -> None:
        frame = frame.sort_values("place")
        self.row = frame["row"].to_numpy()
        self.label = frame["label"].to_numpy(dtype=object)
        self.ints = frame["vector"].to_list()
        self.matrix = _matrix(self.ints)
        self.angles = np.stack(frame["angles"].to_list()).reshape(len(frame), -1)
        self.norm = frame["norm"].to_numpy()
        self.key, self.no_key = frame["key"].to_numpy(), frame["no_key"].to_numpy(dtype=bool)
        self.starts = np.arange(0, len(frame), tile)
        self.ends = np.append(self.starts[1:], len(frame))
        self.windows = frame["windows"].to_list() if "windows" in frame else []

    def widened(self, dims: int) -> None:
        self.matrix = np.pad(self.matrix, ((0, 0), (0, dims - self.matrix.shape[1])))


def _score_bounds(anchors: _Side, rows: _Side) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score of each anchor with any row of each tile."""
    shape = (len(anchors.row), len(rows.starts))
    near, far = np.zeros(shape), np.full(shape, np.pi)
    for of, to in zip(anchors.angles.T, rows.angles.T, strict=True):
        low, high = np.minimum.reduceat(to, rows.starts), np.maximum.reduceat(to, rows.starts)
        of = of[:, None]
        np.maximum(near, np.maximum(of - high, low - of), out=near)
        np.minimum(far, np.minimum(of + high, 2 * np.pi - of - low), out=far)
    highest = np.cos(np.maximum(near - ANGLE_ROUNDING, 0))
    lowest = np.cos(np.minimum(far + ANGLE_ROUNDING, np.pi))
    most = anchors.norm[:, None] * np.maximum.reduceat(rows.norm, rows.starts)
    least = anchors.norm[:, None] * np.minimum.reduceat(rows.norm, rows.starts)
    slack = SCORE_ROUNDING * most + 1
    return np.where(lowest < 0, lowest * most, lowest * least) - slack, np.where(highest > 0, highest * most, highest * least) + slack


def _scores(anchors: _Side, which: np.ndarray, rows: _Side, low: int, end: int) -> np.ndarray:
    """Exact inner products of some anchors and the rows of a tile; what a long cannot hold ends at its limits."""
    if anchors.norm[which].max() * rows.norm[low:end].max() < EXACT:
        return (anchors.matrix[which] @ rows.matrix[low:end].T).astype(np.int64)
    exact = [[sum(int(x) * int(y) for x, y in zip(anchors.ints[a], r, strict=False)) for r in rows.ints[low:end]] for a in which]
    return np.array([[max(-LONGEST, min(LONGEST, s)) for s in line] for line in exact], dtype=np.int64)


class _Best:
    """The best scores of each of ``n`` searches, with all ties of the last of them."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.top = np.full((n, k), -LONGEST - 1, dtype=np.int64)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @property
    def worst(self) -> np.ndarray:
        return self.top[:, 0]

    def offer(self, which: np.ndarray, scores: np.ndarray, valid: np.ndarray, low: int) -> None:
        """Scores of the searches ``which`` with the rows from ``low`` on."""
        valid = valid & (scores >= self.worst[which][:, None])
        some = valid.any(axis=1)
        if not some.any():
            return
        which, scores, valid = which[some], scores[some], valid[some]
        merged = np.concatenate([self.top[which], np.where(valid, scores, -LONGEST - 1)], axis=1)
        self.top[which] = np.sort(np.partition(merged, -self.k, axis=1)[:, -self.k :], axis=1)
        search, row = np.nonzero(valid & (scores >= self.worst[which][:, None]))
        self.found.append((which[search], row + low, scores[search, row]))

    def ranked(self, rows: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(search, row, score) of the ``k`` best of each search, ties by key, null keys last."""
        if not self.found:
            return (np.zeros(0, dtype=np.int64),) * 3
        search, row, score = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((rows.row[row], rows.key[row], rows.no_key[row], -score, search))
        search, row, score = search[order], row[order], score[order]
        first = np.searchsorted(search, search)
        keep = np.arange(len(search)) - first < self.k
        return search[keep], row[keep], score[keep]


def _sides(anchor_frame: pd.DataFrame, row_frame: pd.DataFrame) -> tuple[_Side, _Side]:
    anchors, rows = _Side(anchor_frame, ANCHORS), _Side(row_frame, TILE)
    dims = max(anchors.matrix.shape[1], rows.matrix.shape[1])
    anchors.widened(dims)
    rows.widened(dims)
    return anchors, rows


def _found(anchors: _Side, rows: _Side, anchor: np.ndarray, window: np.ndarray, row: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {"anchor": anchors.row[anchor], "window": window.astype(np.int32), "key": rows.key[row], "no_key": rows.no_key[row], "row": rows.row[row], "score": score}
    )


FOUND = "anchor long, window int, key long, no_key boolean, row long, score long"


def _positives(anchor_frame: pd.DataFrame, row_frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best rows of the anchors' own labels in a block."""
    if not len(anchor_frame) or not len(row_frame):
        return _none()
    anchors, rows = _sides(anchor_frame, row_frame)
    _, most = _score_bounds(anchors, rows)
    best = _Best(len(anchors.row), k)
    for tile in np.argsort(-most.max(axis=0), kind="stable"):
        low, end = rows.starts[tile], rows.ends[tile]
        here = np.isin(anchors.label, rows.label[low:end])
        which = np.flatnonzero(here & (most[:, tile] >= best.worst))
        if len(which):
            valid = (anchors.label[which][:, None] == rows.label[low:end]) & (anchors.row[which][:, None] != rows.row[low:end])
            best.offer(which, _scores(anchors, which, rows, low, end), valid, low)
    anchor, row, score = best.ranked(rows)
    return _found(anchors, rows, anchor, np.zeros(len(anchor)), row, score)


def _negatives(anchor_frame: pd.DataFrame, row_frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best rows of other labels in a block, within each window of each anchor."""
    if not len(anchor_frame) or not len(row_frame):
        return _none()
    anchors, rows = _sides(anchor_frame, row_frame)
    least, most = _score_bounds(anchors, rows)
    n = max(len(w) for w in anchors.windows)
    low_of, high_of = np.full((len(anchors.row), n), LONGEST), np.full((len(anchors.row), n), -LONGEST)
    for a, windows in enumerate(anchors.windows):
        for i, w in enumerate(windows):
            low_of[a, i], high_of[a, i] = w["low"], w["high"]
    bests = [_Best(len(anchors.row), k) for _ in range(n)]
    for tile in np.argsort(-most.max(axis=0), kind="stable"):
        low, end = rows.starts[tile], rows.ends[tile]
        open_ = [(least[:, tile] <= high_of[:, i]) & (most[:, tile] >= np.maximum(low_of[:, i], bests[i].worst)) for i in range(n)]
        which = np.flatnonzero(np.any(open_, axis=0))
        if not len(which):
            continue
        scores = _scores(anchors, which, rows, low, end)
        other = anchors.label[which][:, None] != rows.label[low:end]
        for i, mine in enumerate(open_):
            at = np.flatnonzero(mine[which])
            valid = other[at] & (scores[at] >= low_of[which[at], i][:, None]) & (scores[at] <= high_of[which[at], i][:, None])
            bests[i].offer(which[at], scores[at], valid, low)
    parts = []
    for i, best in enumerate(bests):
        anchor, row, score = best.ranked(rows)
        parts.append(_found(anchors, rows, anchor, np.full(len(anchor), i), row, score))
    return pd.concat(parts, ignore_index=True)


def _none() -> pd.DataFrame:
    return pd.DataFrame({"anchor": [], "window": [], "key": [], "no_key": [], "row": [], "score": []}).astype(
        {"anchor": "int64", "window": "int32", "key": "int64", "no_key": bool, "row": "int64", "score": "int64"}
    )


def _searched(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, search, k: int) -> DataFrame:
    """``search`` over every pair of blocks, and the ``k`` best of each anchor and window over all blocks."""
    pairs = materialize(pairs.select(F.col("r.block").alias("block"), F.col("a.block").alias("with")), "block-pairs")
    left = anchors.withColumnRenamed("block", "with").join(pairs, "with")
    right = rows.join(pairs, "block")
    local = left.groupBy("with", "block").cogroup(right.groupBy("with", "block")).applyInPandas(lambda a, r: search(a, r, k), FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "no_key", "key", "row")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# --- the operator ---------------------------------------------------------------------------


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(256 x); the score of two rows is the integer inner product. An
    anchor's positives are its ``positives`` best other rows of its label, equal scores by the
    smaller key. For each of them the ``negatives`` best rows of other labels follow whose score
    is from ``low`` to ``high`` hundredths of the positive's. All rows are searched, and all
    that ``is_anchor`` selects are anchors; the result is exact.

    Rows with a null label, a null vector or a null or non-finite component take no part.
    Null keys come after all others; rows that repeat a key are rows of their own. A vector with
    fewer components than another counts as if it ended in zeros, so an empty one scores 0.
    Components and scores that a long cannot hold end at its limits. References are chosen among
    ``SAMPLE`` rows; they change how much is scored, not what is found.
    """
    content, number = F.col(f"`{vector}`"), F.col(f"`{key}`").cast("long")
    finite = F.forall(content, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = materialize(
        vectors.filter(F.col(f"`{label}`").isNotNull() & F.coalesce(finite, F.lit(False))).select(
            F.coalesce(number, F.lit(LONGEST)).alias("key"),
            number.isNull().alias("no_key"),
            F.col(f"`{label}`").cast("string").alias("label"),
            F.transform(content, lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "usable",
    )
    sample = usable.select("vector", "row").orderBy(F.xxhash64("key"), "row").limit(SAMPLE).collect()  # bounded
    directions = references(_matrix([r.vector for r in sample]))
    n_angles = len(directions)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in usable.schema)
    angled = usable.mapInPandas(lambda b: _with_angles(b, directions), f"{kind}, norm double, angles array<double>, close int, least double")
    rows = _blocks(angled, ROWS, "rows")
    anchors = _blocks(rows.filter("is_anchor").drop("place", "block"), ANCHORS, "anchors")
    n_blocks = (anchors.agg(F.max("block")).first()[0] or 0) + 1
    summaries = materialize(_summary(rows, n_angles), "summaries")
    same = (F.col("r.label_from") <= F.col("a.label_to")) & (F.col("a.label_from") <= F.col("r.label_to"))
    near = _pairs(summaries, _summary(anchors, n_angles), n_blocks).filter(same)
    best = materialize(_searched(near, anchors, rows, _positives, positives).drop("window"), "positives")

    # Bounds are products of longs and numbers below 100, so they are taken as decimals.
    share = lambda c, s: F.col(c).cast("decimal(38,0)") * s / 100
    window = F.struct(
        F.ceil(share("score", low)).cast("long").alias("low"), F.floor(share("score", high)).cast("long").alias("high"), "score", "key", "no_key"
    )
    windows = best.groupBy(F.col("anchor").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", window.alias("w")))), lambda x: x.w).alias("windows"))
    asking = materialize(anchors.join(windows, "row"), "asking")
    first, last = F.array_min(F.transform("windows", lambda w: w.low)), F.array_max(F.transform("windows", lambda w: w.high))
    asked = _summary(asking, n_angles, F.min(first).alias("low"), F.max(last).alias("high"))
    one = (F.col("r.label_from") == F.col("r.label_to")) & (F.col("a.label_from") == F.col("a.label_to")) & (F.col("r.label_from") == F.col("a.label_from"))
    within = (F.col("least") <= F.col("a.high")) & (F.col("most") >= F.col("a.low"))
    overlapping = _bounded(_pairs(summaries, asked, n_blocks).filter(~one)).filter(within)
    searchers = asking.withColumn("windows", F.transform("windows", lambda w: F.struct(w.low.alias("low"), w.high.alias("high"))))
    hard = _searched(overlapping, searchers, rows, _negatives, negatives)
    found = hard.select("anchor", "window", "rank", F.when(~F.col("no_key"), F.col("key")).alias("negative_id"), F.col("score").alias("negative_score"))
    about = asking.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"), "no_key", F.posexplode("windows").alias("window", "w"))
    out = found.join(about, ["anchor", "window"]).select(
        F.when(~F.col("no_key"), F.col("anchor_id")).alias("anchor_id"),
        F.when(~F.col("w.no_key"), F.col("w.key")).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("w.score").alias("positive_score"),
        "negative_score",
    )
    return out.to(StructType.fromDDL(SCHEMA))
