"""Packing of documents into fixed windows of tokens by the online sum-of-squares rule.

Each task packs the documents of its input split, one after another, and needs no other task:
nothing is shuffled. A level array counts the windows that are filled up to each level. A
document goes to the level at which the sum of the squared counts becomes least, so that no
level gathers many windows. Documents may be cut: what exceeds whole windows fills windows of
its own, and where the squares would grow by more than the price of a cut, a document first fills
up a window of the most frequent level. So there are never many windows of a level, whatever the
sizes. At the end the emptiest windows are dealt out to the gaps of the fullest.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, text_or_empty

by_value(__name__)

WINDOW = 1024
#: Closes every document.
END = 0
#: What a cut costs, in squared counts. It bounds how many windows a level keeps.
CUT = 4
#: Cuts text into pieces before the merges; a fixed value of the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}
OUTPUT = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def load_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary in the rank file at ``path``."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


class Packer:
    """The windows of one task: a piece is (key, start, ids, doc_tokens)."""

    def __init__(self, window: int, cut: int) -> None:
        self.window, self.cut = window, cut
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.at: dict[int, list[list[tuple]]] = {}
        #: Pieces that the rule has placed, and those that were moved at the end.
        self.placed = self.moved = 0

    def level_for(self, size: int) -> tuple[int, int]:
        """The level after which the sum of squared counts is least, of equals the fullest, and by how much it grows.

        Level 0 stands for a new window. A window filled up counts no more.
        """
        levels = np.arange(self.window - size + 1)
        counts, after = self.counts[: len(levels)], self.counts[size:]
        change = np.where(levels > 0, 1 - 2 * counts, 0) + np.where(levels + size < self.window, 2 * after[: len(levels)] + 1, 0)
        change[1:][counts[1:] == 0] = np.iinfo(np.int64).max
        level = int(len(change) - 1 - np.argmin(change[::-1]))
        return level, int(change[level])

    def add(self, key, ids: array) -> Iterator[list[tuple]]:
        """Place a document; yields windows that are full."""
        n = len(ids)
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            self.placed += 1
            yield [(key, start, ids[start : start + self.window], n)]
        while whole < n:
            level, growth = self.level_for(n - whole)
            size = n - whole
            if growth > 0 and self.window - size + 1 < self.window:
                # A window with less room than the document has, of the most frequent level.
                most = self.window - size + 1 + int(np.argmax(self.counts[self.window - size + 1 : self.window]))
                if self.counts[most]:
                    rest = size - (self.window - most)
                    if 1 - 2 * int(self.counts[most]) + self.level_for(rest)[1] + self.cut < growth:
                        level, size = most, self.window - most
            yield from self._put(level, (key, whole, ids[whole : whole + size], n))
            whole += size

    def _put(self, level: int, piece: tuple) -> Iterator[list[tuple]]:
        window = []
        if level:
            window = self.at[level].pop()
            self.counts[level] -= 1
        window.append(piece)
        self.placed += 1
        level += len(piece[2])
        if level == self.window:
            yield window
        else:
            self.at.setdefault(level, []).append(window)
            self.counts[level] += 1

    def finish(self) -> Iterator[list[tuple]]:
        """Fill up the fullest windows from the emptiest; what is left at last goes into windows of powers of two."""
        levels = [(level, w) for level in sorted(self.at, reverse=True) for w in self.at[level]]
        self.at, self.counts[:] = {}, 0
        while len(levels) > 1:
            level, window = levels[0]
            other, pieces = levels[-1]
            key, start, ids, n = pieces.pop()
            take = min(self.window - level, len(ids))
            window.append((key, start, ids[:take], n))
            self.moved += 1
            if take < len(ids):
                pieces.append((key, start + take, ids[take:], n))
            levels[0] = (level + take, window)
            levels[-1] = (other - take, pieces)
            if not pieces:
                levels.pop()
            if level + take == self.window:
                yield window
                levels.pop(0)
        for left, pieces in levels:
            room, window = 0, []
            for key, start, ids, n in pieces:
                at = 0
                while at < len(ids):
                    room = room or 1 << (left.bit_length() - 1)
                    take = min(room, len(ids) - at)
                    window.append((key, start + at, ids[at : at + take], n))
                    at, room, left = at + take, room - take, left - take
                    if not room:
                        yield window
                        window = []


def pack(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    cut: int = CUT,
) -> DataFrame:
    """One row per piece: ``key`` and start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds unsigned 32-bit little-endian token ids; each document ends with ``END``.
    ``start`` counts the document's tokens before the piece, ``offset`` those of the sequence.
    Every token lies in exactly one piece. Sequences are full but for at most one per power of
    two below ``window`` and task, which have that length. Null and empty
    texts are the end token alone; rows with equal or null keys are packed one by one; other
    columns are not returned. ``vocabulary`` names a rank file that every executor can read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = load_encoding(vocabulary)
        packer = Packer(window, cut)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 36
        rows: list[tuple] = []

        def numbered(windows: Iterator[list[tuple]]) -> None:
            nonlocal sequence
            for pieces in windows:
                offset = 0
                for id_, start, ids, n in pieces:
                    rows.append((id_, start, len(ids), ids.tobytes(), n, sequence, offset))
                    offset += len(ids)
                sequence += 1

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            rows.clear()
            return out

        for batch in batches:
            for id_, content in zip(batch["key"].astype(object).where(batch["key"].notna(), None), batch["text"], strict=True):
                ids = array("I", encoding.encode(content, allowed_special="all"))
                ids.append(END)
                numbered(packer.add(id_, ids))
                if len(rows) >= 2000:
                    yield frame()
        numbered(packer.finish())
        yield frame()

    return (
        docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text"))
        .mapInPandas(packed, f"key {kind}, {OUTPUT}")
        .withColumnRenamed("key", key)
    )
