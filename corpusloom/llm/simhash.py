"""SimHash near-duplicates, linked over the anchors of a covering code.

A fingerprint has 64 bits, cut into two coded blocks of 24 bits and an exact block of 16. If
two fingerprints differ in at most 4 bits, then either a coded block differs in at most one
bit or the exact block is equal: else there were 2 + 2 + 1 differences. The anchors of a coded
block are the words of a product code: Hamming [15,11], Hamming [7,4] and 2 bare bits, a
covering code of radius 2. A fingerprint goes to every anchor that is the nearest one of some
word within one bit of its own block: these are the anchors within covering radius plus
threshold that can matter, 13 at most. Of two blocks within one bit, one's own anchor is thus
among the other's, and the two meet there. The exact block is a code of radius 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing, materialize
from corpusloom.llm.components import components
from corpusloom.session import salted_join

by_value(__name__)

THRESHOLD = 4
SHINGLE = 5
CODED_BITS = 24
#: Members of one anchor that a task compares; larger anchors are compared in pairs of such parts.
PART = 8192
#: Up to this many members an anchor is compared in passes over all anchors at once.
SMALL = 64
OUTPUT = ("fingerprint", "component_id", "component", "stays")


# --- fingerprints ---------------------------------------------------------------------------


def _shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles of a text, repeats included; unsigned.

    Words are cut at ASCII white space after A-Z are lower-cased. A text of fewer words than a
    shingle is one shingle; a text without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), last.tolist(), strict=False)], dtype="<u8")


def _majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that more than half of the rows of ``hashes`` (rows x words of 64 bits) have, as 64-bit words."""
    set_bits = np.zeros(64 * hashes.shape[1], dtype=np.int64)
    step = 65536 // hashes.shape[1]
    for at in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[at : at + step])
        set_bits += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits((2 * set_bits > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as an unsigned number; texts without words have zero."""
    hashes = _shingle_hashes(text, shingle)
    return int(_majority(hashes[:, None])[0]) if len(hashes) else 0


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a text column as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


# --- anchors --------------------------------------------------------------------------------


def _syndrome(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.uint64)
    for i in range(n):
        out ^= ((words >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return out


def _nearest(words: np.ndarray, n: int) -> np.ndarray:
    """The nearest word of the Hamming code of length ``n``."""
    s = _syndrome(words, n)
    return np.where(s > 0, words ^ (np.uint64(1) << (s - np.uint64(1)) % np.uint64(64)), words)


def _home(blocks: np.ndarray) -> np.ndarray:
    """The nearest anchor of 24-bit blocks."""
    low, mid = blocks & np.uint64(0x7FFF), (blocks >> np.uint64(15)) & np.uint64(0x7F)
    bare = blocks >> np.uint64(22)
    return _nearest(low, 15) | _nearest(mid, 7) << np.uint64(15) | bare << np.uint64(22)


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index of the fingerprint): all anchors of unsigned fingerprints, each once.

    An anchor's number also holds which block it belongs to.
    """
    found, index = [], []
    rows = np.arange(len(prints))
    for block in range(2):
        words = (prints >> np.uint64(CODED_BITS * block)) & np.uint64((1 << CODED_BITS) - 1)
        near = np.stack([_home(words), *(_home(words ^ np.uint64(1 << i)) for i in range(CODED_BITS))], axis=1)
        near.sort(axis=1)
        first = np.ones(near.shape, dtype=bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        found.append(near[first] | np.uint64(block << 32))
        index.append(np.repeat(rows, first.sum(axis=1)))
    found.append((prints >> np.uint64(2 * CODED_BITS)) | np.uint64(2 << 32))
    index.append(rows)
    return np.concatenate(found), np.concatenate(index)


def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found, index = anchors(batch["print"].to_numpy().view(np.uint64))
        yield pd.DataFrame({"anchor": found.view(np.int64), **{c: batch[c].to_numpy()[index] for c in batch.columns}})


class _Members:
    """Fingerprints of a partition."""

    def __init__(self, frame: pd.DataFrame, threshold: int) -> None:
        self.prints = frame["print"].to_numpy().view(np.uint64)
        self.threshold = threshold

    def near(self, a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
        """Which members ``a`` are linked to their partners ``b``."""
        return np.bitwise_count(self.prints[a] ^ self.prints[b]) <= self.threshold

    def forest(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Links that join all members of one anchor that reach each other: one fewer than members."""
        left = np.arange(low, high)
        while len(left):
            frontier, left = [int(left[0])], left[1:]
            while frontier and len(left):
                u = frontier.pop()
                near = self.near(left, u)
                if near.any():
                    found = left[near].tolist()
                    yield from ((u, v) for v in found)
                    frontier.extend(found)
                    left = left[~near]


def _links(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """Links inside the anchors of a partition that is sorted by anchor."""

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame[["anchor", "a", "b"]].to_numpy()
        members = _Members(frame, threshold)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(keys)))
        busy = sizes > SMALL
        for step in range(1, int(sizes[~busy].max(initial=0))):
            at = np.flatnonzero(group[step:] == group[:-step])
            busy[group[at[members.near(at, at + step)]]] = True
        pairs = [p for g in np.flatnonzero(busy) for p in members.forest(starts[g], starts[g] + sizes[g])]
        u, v = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        prints = frame["print"].to_numpy()
        return pd.DataFrame({"u": prints[u], "v": prints[v]})

    yield from _grouped(batches, ["anchor", "a", "b"], linked)


def _grouped(
    batches: Iterator[pd.DataFrame], by: list[str], linked: Callable[[pd.DataFrame], pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    """``linked`` of whole groups, of a partition that is sorted ``by`` their keys."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = (batch[by] == batch[by].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield linked(pd.concat([*held, batch.iloc[:cut]], ignore_index=True))
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield linked(pd.concat(held, ignore_index=True))


def _dealt(rows: DataFrame, group: str, columns: list[str], key: str, size: int) -> DataFrame:
    """``rows`` by group and pair of parts (a, b) of at most about ``size`` members each, dealt by hash of the key."""
    large = rows.groupBy(group).count().filter(F.col("count") > size)
    return (
        rows.join(large, group, "left")
        .select(group, *columns, F.coalesce(F.ceil(F.col("count") / size), F.lit(1)).cast("int").alias("parts"))
        .withColumn("mine", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
        .select(group, *columns, "mine", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(group, F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), *columns)
        .repartition(group, "a", "b")
        .sortWithinPartitions(group, "a", "b")
    )


def link_prints(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (u, v) that connect all of the distinct ``print`` values within ``threshold`` bits.

    Only enough links to connect a group are returned: as many as it has members, never its
    pairs. An anchor of more than ``PART`` members is cut into parts by hash and compared part
    by part, so that no task holds more than two parts of one anchor.
    """
    if threshold > THRESHOLD:
        raise ValueError(f"the code covers up to {THRESHOLD} differing bits")
    placed = materialize(prints.select("print").mapInPandas(_anchored, "anchor long, print long"), "anchors")
    dealt = _dealt(placed, "anchor", ["print"], "print", PART)
    return dealt.mapInPandas(lambda batches: _links(batches, threshold), "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    keep_text: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with its ``fingerprint`` (long), ``component_id``, ``component`` and ``stays``.

    Rows are in one component if links of at most ``threshold`` differing bits connect them;
    the component is named by its least ``key`` that is not null (null if there is none). Null
    and empty texts have the fingerprint zero and are linked like any other. Equal
    fingerprints are one node, so groups of copies cost nothing after the first. ``component``
    is the least fingerprint of the component, and never null. ``stays`` is true for exactly one
    row of each component, one of its least key. The text itself is returned only with ``keep_text``. Input columns named like an added one are replaced.
    """
    rows = drop_clashing(docs, *OUTPUT)
    content = F.col(f"`{text}`").cast("string")
    printed = rows.withColumns({"fingerprint": fingerprints(content, shingle), "__op_row": F.monotonically_increasing_id()})
    narrow = materialize(printed if keep_text else printed.drop(text), "prints")
    first = F.min(F.struct(F.col(f"`{key}`").isNull(), F.col(f"`{key}`").alias("key"), "__op_row"))  # null keys come last
    nodes = materialize(narrow.groupBy(F.col("fingerprint").alias("node")).agg(first.alias("least")), "nodes")
    links = link_prints(nodes.select(F.col("node").alias("print")), threshold)
    placed = nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("least").alias("one"))
    # One component may hold a large share of all nodes.
    labels = salted_join(placed, named, ["root"], spread=["node"], how="inner").select(
        "node",
        F.col("one.key").alias("component_id"),
        F.col("root").alias("component"),
        F.col("one.__op_row").alias("__op_one"),
    )
    return narrow.join(labels, narrow["fingerprint"] == labels["node"], "left").select(
        *(narrow[f"`{c}`"] for c in rows.columns if keep_text or c != text),
        *OUTPUT[:-1],
        (F.col("__op_row") == F.col("__op_one")).alias("stays"),
    )
