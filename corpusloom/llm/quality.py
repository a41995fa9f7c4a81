"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words and of their character n-grams, each
looked up in a hashed table, next to the mean of the vectors of a few words that describe the
document as a whole (how far its words and lines repeat, how long it is). Softmax over both
means gives the score. Vectors and output are trained by stochastic gradient descent in
numpy, on a bounded sample of labelled documents.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing, text_or_empty

by_value(__name__)

BUCKETS = 1 << 15
DIMENSIONS = 8
NGRAMS = (3, 4)
#: Labelled documents that the classifier is fitted on, at most; those of least hash are taken.
SAMPLE = 4000
#: Longer documents are not fitted on, so that the sample is bounded in size too. They are scored like any other.
LONGEST = 50_000
EPOCHS = 12
RATE = 0.5
BATCH = 16
SEED = 7
THRESHOLD = 0.7
#: Words that a task remembers the score of.
KNOWN_WORDS = 500_000
#: Documents that are scored together.
CHUNK = 256
OUTPUT = ("score", "predicted")


def table_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, table row) for the words themselves and the n-grams of their bytes between marks."""
    marked = [f"<{w}>".encode() for w in words]
    size = np.array([len(m) for m in marked], dtype=np.int64)
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    room = np.repeat(np.cumsum(size), size) - np.arange(len(data))
    owners, rows = [np.arange(len(words))], [np.array([zlib.crc32(m) % BUCKETS for m in marked], dtype=np.int64)]
    for n in NGRAMS:
        at = np.flatnonzero(room >= n)
        gram = np.full(len(at), np.uint64(n))
        for i in range(n):
            gram = (gram ^ data[at + i]) * np.uint64(0x100000001B3)
        owners.append(owner[at])
        rows.append(((gram ^ (gram >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(rows)


def shape_words(text: str, words: Counter, total: int) -> list[str]:
    """Words for the document as a whole."""
    lines = [x for x in text.split("\n") if x]
    repeat = 1 - len(words) / total if total else 0.0
    top = max(words.values(), default=0) / total if total else 0.0
    same = 1 - len(set(lines)) / len(lines) if lines else 0.0
    size = total.bit_length()
    return [
        f"\0size {size}",
        f"\0repeat {size} {int(repeat * 16)}",
        f"\0top {size} {int(top * 16)}",
        f"\0lines {int(same * 8)}",
    ]


def document_features(text: str | None) -> tuple[Counter, int, list[str]]:
    """(words with their counts, number of words, words for the whole)."""
    words = Counter((text or "").split())
    total = sum(words.values())
    return words, total, shape_words(text or "", words, total)


class Model:
    """Vectors of table rows, output weights for both means, and bias; class 1 is good."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
        self.output = np.zeros((2 * DIMENSIONS, 2))
        self.bias = np.zeros(2)

    def fit(self, texts: list[str], labels: list[int]) -> Model:
        """Minimise cross-entropy by gradient steps on small random batches of documents."""
        rng = np.random.default_rng(SEED)
        # One long array for each: their memory goes back to the system at the end, that of many small ones would not.
        every_row, every_share, bounds, shapes = array("i"), array("d"), [0], []
        for text in texts:
            words, _, shape = document_features(text)
            owner, rows = table_rows(list(words))
            rows, place = np.unique(rows, return_inverse=True)
            share = np.bincount(place, np.fromiter(words.values(), dtype=np.float64, count=len(words))[owner], len(rows))
            every_row.frombytes(rows.astype(np.int32).tobytes())
            every_share.frombytes((share / max(share.sum(), 1.0)).tobytes())
            bounds.append(len(every_row))
            shapes.append(np.array([zlib.crc32(s.encode()) % BUCKETS for s in shape]))
        all_rows, all_shares = np.frombuffer(every_row, dtype=np.int32), np.frombuffer(every_share)
        docs = [(all_rows[a:b], all_shares[a:b], shape) for a, b, shape in zip(bounds[:-1], bounds[1:], shapes, strict=True)]
        gold = np.array(labels, dtype=np.int64)
        steps = EPOCHS * max(1, -(-len(docs) // BATCH))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                rate = RATE * (1 - step / steps)
                step += 1
                mine = order[at : at + BATCH]
                hidden = np.stack([self._means(*docs[i]) for i in mine])
                error = _softmax(hidden @ self.output + self.bias)
                error[np.arange(len(mine)), gold[mine]] -= 1
                back = error @ self.output.T
                self.output -= rate * hidden.T @ error
                self.bias -= rate * error.sum(axis=0) / len(mine)
                for i, g in zip(mine, back, strict=True):
                    rows, share, shape = docs[i]
                    self.vectors[rows] -= rate * share[:, None] * g[:DIMENSIONS] * 4
                    np.add.at(self.vectors, shape, -rate * g[DIMENSIONS:] / len(shape))
        return self

    def _means(self, rows: np.ndarray, share: np.ndarray, shape: np.ndarray) -> np.ndarray:
        return np.concatenate([share @ self.vectors[rows], self.vectors[shape].mean(axis=0)])

    def score(self, texts: Sequence[str | None], known: dict[str, tuple[float, int]]) -> np.ndarray:
        """Probability of class 1. The output is linear in the means, so each word counts by one
        number, which ``known`` remembers."""
        side = self.output[:, 1] - self.output[:, 0]
        by_word, by_shape = self.vectors @ side[:DIMENSIONS], self.vectors @ side[DIMENSIONS:]
        logits = [self._logits(texts[i : i + CHUNK], known, by_word, by_shape) for i in range(0, len(texts), CHUNK)]
        return 1 / (1 + np.exp(-(np.concatenate([[], *logits]) + self.bias[1] - self.bias[0])))

    @staticmethod
    def _logits(texts: Sequence[str | None], known: dict, by_word: np.ndarray, by_shape: np.ndarray) -> np.ndarray:
        docs = [document_features(t) for t in texts]
        new = list({w for words, _, _ in docs for w in words if w not in known})
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            owner, rows = table_rows(part)
            sums, counts = np.bincount(owner, by_word[rows], len(part)), np.bincount(owner, minlength=len(part))
            known.update(zip(part, zip(sums.tolist(), counts.tolist(), strict=True), strict=True))
        out = []
        for words, _, shape in docs:
            total, rows = 0.0, 0
            for word, n in words.items():
                z, m = known[word]
                total += n * z
                rows += n * m
            shaped = by_shape[[zlib.crc32(s.encode()) % BUCKETS for s in shape]].mean()
            out.append((total / rows if rows else 0.0) + shaped)
        if len(known) > KNOWN_WORDS:
            known.clear()
        return np.array(out, dtype=np.float64)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(key: Column) -> Column:
    """Rows that training never sees: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Model:
    """Fit on at most ``sample`` labelled documents of up to ``LONGEST`` characters that are not held out.

    Labels other than 0 and 1, null keys and keys without a document are passed over. Of
    several labels for one key the least counts. Without labels the model says 1/2.
    """
    marked = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(key)
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64(key), key)
        .limit(sample)
    )
    rows = (
        docs.select(F.col(f"`{key}`").alias(key), text_or_empty(text).alias("_text"))
        .filter(F.char_length("_text") <= LONGEST)
        .join(marked, key)
        .dropDuplicates([key, "_text"])
        .orderBy(F.xxhash64(key), key, F.xxhash64("_text"))
        .limit(sample)
        .collect()
    )
    model = Model()
    return model.fit([r["_text"] for r in rows], [int(r["_label"]) for r in rows]) if rows else model


def classify(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of good quality) and ``predicted`` (1 from ``threshold``).

    Whole texts are scored, where they are read; nothing is shuffled. Null and empty texts are
    scored by length alone, as texts without words. Input columns named like an added one are
    replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: the hashed table

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[float, int]] = {}
        for texts in batches:
            yield pd.Series(shared.value.score(list(texts), known))

    rows = drop_clashing(docs, *OUTPUT)
    return rows.withColumn("score", scores(text_or_empty(text))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
