"""Exact top-k search: BM25 over an inverted index with block-max WAND, merged over shards.

A shard is a bounded run of documents of one input split. Its index has a row per term and
block of postings, with what bounds the block's scores: the greatest frequency and the least
document length. Global document counts and lengths make scores comparable; each shard
returns its best ``k`` per query and the best of these are the answer.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heapreplace
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, materialize, text_or_empty

by_value(__name__)

K1, B = 1.2, 0.75
BLOCK = 128
#: Documents and words of a shard, at most; a longer document is a shard of its own.
SHARD_DOCS = 4096
SHARD_WORDS = 1_000_000
WORD = re.compile(r"[^\W_]+")
INDEX = "shard long, term string, block int, ids array<int>, counts array<int>, most int, shortest int"


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORD.findall(text.lower())


def _blocks(shard: int, docs: list[Counter], lengths: list[int]) -> pa.RecordBatch:
    """The inverted index of one shard."""
    terms: dict[str, int] = {}
    code = np.array([terms.setdefault(w, len(terms)) for d in docs for w in d], dtype=np.int64)
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    ids = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
    counts = np.array([n for d in docs for n in d.values()], dtype=np.int32)
    order = np.argsort(code, kind="stable")
    code, ids, counts = code[order], ids[order], counts[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    rank = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
    starts = np.flatnonzero(rank % BLOCK == 0)
    offsets = pa.array(np.append(starts, len(code)).astype(np.int32))
    names = np.array(list(terms), dtype=object)
    size = np.array(lengths, dtype=np.int32)[ids]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(starts), shard, dtype=np.int64)),
            pa.array(names[code[starts]], type=pa.string()),
            pa.array((rank[starts] // BLOCK).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(ids)),
            pa.ListArray.from_arrays(offsets, pa.array(counts)),
            pa.array(np.maximum.reduceat(counts, starts) if len(starts) else counts),
            pa.array(np.minimum.reduceat(size, starts) if len(starts) else size),
        ],
        names=["shard", "term", "block", "ids", "counts", "most", "shortest"],
    )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(index, shards), both written to the shared folder.

    ``index`` has every word of every text; ``shards`` the keys and lengths of each shard's
    documents, by their number there. Documents without words (null, empty) are in no
    posting but count as documents. Nothing is shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = (context.partitionId() if context else 0) << 32
        keys, held, lengths = [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            index = _blocks(shard, held, lengths)
            n = index.num_rows
            about = [pa.list_(key_type), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([*index.columns, *(pa.nulls(n, t) for t in about)], names=columns)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], type=pa.int64()),
                    *(pa.nulls(1, t) for t in index.schema.types[1:]),
                    pa.array([keys], type=about[0]),
                    pa.array([lengths], type=about[1]),
                ],
                names=columns,
            )
            shard += 1
            for x in (keys, held, lengths):
                x.clear()

        columns = ["shard", "term", "block", "ids", "counts", "most", "shortest", "keys", "lengths"]
        key_type, total = None, 0
        for batch in batches:
            key_type = batch.column(0).type
            for id_, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(content)
                if held and (len(held) == SHARD_DOCS or total + len(words) > SHARD_WORDS):
                    yield from done()
                    total = 0
                total += len(words)
                keys.append(id_)
                held.append(Counter(words))
                lengths.append(len(words))
        if held:
            yield from done()

    whole = materialize(
        docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text")).mapInArrow(
            built, f"{INDEX}, keys array<{kind}>, lengths array<int>"
        ),
        "index",
    )
    return (
        whole.filter(F.col("term").isNotNull()).drop("keys", "lengths"),
        whole.filter(F.col("term").isNull()).select("shard", "keys", "lengths"),
    )


class _Cursor:
    """Postings of one term in one shard."""

    __slots__ = ("ids", "counts", "ends", "bounds", "bound", "weight", "at", "doc")

    def __init__(self, blocks: list, weight: float, average: float) -> None:
        self.ids = np.concatenate([b[1] for b in blocks]).tolist()
        self.counts = np.concatenate([b[2] for b in blocks]).tolist()
        self.ends = [int(b[1][-1]) for b in blocks]
        self.bounds = [weight * share(b[3], b[4], average) for b in blocks]
        self.bound, self.weight = max(self.bounds), weight
        self.at, self.doc = 0, self.ids[0]

    def seek(self, doc: int) -> None:
        self.at = bisect_left(self.ids, doc, self.at)
        self.doc = self.ids[self.at] if self.at < len(self.ids) else -1


def share(count: int, length: int, average: float) -> float:
    """What a term's frequency in a document makes of its weight; more with it, less with the length."""
    return count * (K1 + 1) / (count + K1 * (1 - B + B * length / average))


def _rank(key) -> tuple:
    return (key is None, key if key is not None else 0)


class _Worst:
    """Heap entry that orders the worst result first: least score, then greatest key."""

    __slots__ = ("score", "key")

    def __init__(self, score: float, key) -> None:
        self.score, self.key = score, key

    def __lt__(self, other: _Worst) -> bool:
        return (self.score, _rank(other.key)) < (other.score, _rank(self.key))


def search_shard(cursors: list[_Cursor], keys: list, lengths: list[int], average: float, k: int, best: list[_Worst]) -> None:
    """Block-max WAND over one shard; ``best`` is the heap of the best ``k`` and is improved.

    Documents are passed over only while the sum of bounds is below the worst of ``k`` by more
    than rounding can make, so that equal scores are still compared by key.
    """
    order = list(cursors)
    while True:
        order = sorted((c for c in order if c.doc >= 0), key=lambda c: c.doc)
        need = best[0].score * (1 - 1e-9) if len(best) == k else -1.0
        total, pivot = 0.0, -1
        for i, c in enumerate(order):
            total += c.bound
            if total >= need:
                pivot = i
                break
        if pivot < 0:
            return
        doc = order[pivot].doc
        while pivot + 1 < len(order) and order[pivot + 1].doc == doc:
            pivot += 1
        blocks = [bisect_left(c.ends, doc) for c in order[: pivot + 1]]
        near = sum(c.bounds[b] for c, b in zip(order, blocks, strict=False) if b < len(c.ends))
        if near >= need:
            if order[0].doc == doc:
                score = 0.0
                for c in cursors:  # always in the order of terms: sums do not depend on the shard
                    if c.doc == doc:
                        score += c.weight * share(c.counts[c.at], lengths[doc], average)
                entry = _Worst(score, keys[doc])
                if len(best) < k:
                    heappush(best, entry)
                elif best[0] < entry:
                    heapreplace(best, entry)
                for c in order[: pivot + 1]:
                    c.seek(doc + 1)
            else:
                for c in order[:pivot]:
                    if c.doc < doc:
                        c.seek(doc)
        else:
            ends = [c.ends[b] + 1 for c, b in zip(order, blocks, strict=False) if b < len(c.ends)]
            beyond = [order[pivot + 1].doc] if pivot + 1 < len(order) else []
            target = max(doc + 1, min(ends + beyond))
            for c in order[: pivot + 1]:
                c.seek(target)


def search(
    index: DataFrame, shards: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """(query_id, key, score, rank): the ``k`` best documents of each query, with all ties decided.

    BM25 with the frequency of a word in the query as a factor. Equal scores go by key, null
    keys last. Only documents with a word of the query are found; queries without words (null,
    empty) have no rows. Rows of ``queries`` with one id are searched as one text. The index
    blocks of the queries' words are moved to their shard's task, nothing else is; queries are
    a stated set and are held by each task.
    """
    key_type = shards.schema["keys"].dataType.elementType.simpleString()
    words = F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"([\p{L}\p{N}]+)"))
    asked = queries.select(F.col(f"`{query_id}`").alias("query"), F.explode(words).alias("term")).groupBy("query", "term").agg(
        F.count("*").alias("times")
    )
    asked = materialize(asked, "asked")
    wanted = materialize(index.join(asked.select("term").distinct(), "term", "left_semi"), "wanted-blocks")
    df = wanted.groupBy("term").agg(F.sum(F.size("ids")).alias("df"))
    size = shards.select(F.sum(F.size("lengths")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words"))
    n, total = size.first()
    if not n or not total:
        return queries.sparkSession.createDataFrame([], f"{query_id} {asked.schema['query'].dataType.simpleString()}, key {key_type}, score double, rank int")
    weights: dict = {}
    for r in asked.join(df, "term").select("query", "term", "times", "df").collect():  # words of the stated queries
        weights.setdefault(r.query, {})[r.term] = r.times * log(1 + (n - r.df + 0.5) / (r.df + 0.5))
    shared = queries.sparkSession.sparkContext.broadcast(weights)
    average = total / n
    query_type = asked.schema["query"].dataType.simpleString()

    def searched(shard: tuple, blocks: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(blocks) and len(about):
            keys, lengths = list(about["keys"].iloc[0]), np.asarray(about["lengths"].iloc[0]).tolist()
            by_term: dict[str, list] = {}
            for b in blocks.sort_values(["term", "block"]).itertuples(index=False):
                by_term.setdefault(b.term, []).append((b.block, np.asarray(b.ids), np.asarray(b.counts), b.most, b.shortest))
            for query, terms in shared.value.items():
                cursors = [_Cursor(by_term[t], w, average) for t, w in sorted(terms.items()) if t in by_term]
                best: list[_Worst] = []
                if cursors:
                    search_shard(cursors, keys, lengths, average, k, best)
                rows += [(query, b.key, b.score) for b in best]
        return pd.DataFrame(rows, columns=["query", "key", "score"]).astype({"query": object, "key": object, "score": float})

    local = (
        wanted.groupBy("shard")
        .cogroup(shards.groupBy("shard"))
        .applyInPandas(searched, f"query {query_type}, key {key_type}, score double")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return (
        local.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias(query_id), "key", "score", "rank")
    )
