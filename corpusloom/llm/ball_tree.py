"""Ranked lexical search as exact inner products, over a sparse ball tree per shard.

A shard is a bounded run of documents of one input split. Of the stored index only the postings
of asked terms go on. A shard's documents, as sparse vectors over these terms, are halved along
the line between two far ones, in a random projection, until a leaf is small; each node of the
tree knows the centroid of its documents and the radius around it. A query's score with any
document of a node is at most its product with the centroid plus its length times the radius,
widened by what rounding may cost. Nodes are visited best first until that bound is below the
worst of the best found. Documents of a leaf are scored in 64-bit integers. Each shard returns
its best, the best of these are the answer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, materialize, text_or_empty
from corpusloom.session import salted_join

by_value(__name__)

#: Documents and words of a shard, at most; a longer document is a shard of its own.
SHARD_DOCS, SHARD_WORDS = 4096, 1_000_000
#: Documents of a leaf, dimensions of the sketch by which documents are halved, queries that one task answers.
LEAF, DIRECTIONS, QUERIES = 64, 16, 256
#: What rounding may change about a bound, in relation to its parts.
ROUNDING = 1e-9
#: Bytes that part words become spaces, A-Z become a-z; bytes of other characters are kept.
_BYTES = bytes(
    b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


# --- index ----------------------------------------------------------------------------------

INDEX = "shard long, term binary, ids array<int>, counts array<int>"


def _postings(shard: int, docs: list[Counter]) -> list[pa.Array]:
    """The columns of ``INDEX`` for the documents of one shard."""
    terms: dict[bytes, int] = {}
    code = np.array([terms.setdefault(w, len(terms)) for d in docs for w in d], dtype=np.int64)
    ids = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) for d in docs])
    counts = np.array([n for d in docs for n in d.values()], dtype=np.int32)
    order = np.argsort(code, kind="stable")
    offsets = pa.array(np.searchsorted(code[order], np.arange(len(terms) + 1)).astype(np.int32))
    return [
        pa.array(np.full(len(terms), shard, dtype=np.int64)),
        pa.array(list(terms), type=pa.binary()),
        pa.ListArray.from_arrays(offsets, pa.array(ids[order])),
        pa.ListArray.from_arrays(offsets, pa.array(counts[order])),
    ]


def _by_key(held: list[tuple]) -> list[tuple]:
    return sorted(held, key=lambda d: (d[0] is None, d[0] if d[0] is not None else 0))


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(index, shards), both written to the shared folder.

    ``index`` has every term of every text by shard; ``shards`` the keys and numbers of terms of
    each shard's documents, in the order of their keys, null keys last. Nothing is shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = (context.partitionId() if context else 0) << 32
        names = ["shard", "term", "ids", "counts", "keys", "lengths"]
        held, total, key_type = [], 0, pa.null()

        def done() -> Iterator[pa.RecordBatch]:
            ordered = _by_key(held)
            index = _postings(shard, [words for _, words, _ in ordered])
            keys, lengths = pa.array([[d[0] for d in ordered]], type=pa.list_(key_type)), pa.array([[d[2] for d in ordered]], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*index, *(pa.nulls(len(index[0]), x.type) for x in (keys, lengths))], names=names)
            yield pa.RecordBatch.from_arrays([pa.array([shard], type=pa.int64()), *(pa.nulls(1, x.type) for x in index[1:]), keys, lengths], names=names)

        for batch in batches:
            key_type = batch.column(0).type
            for id_, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(content)
                if held and (len(held) == SHARD_DOCS or total + len(words) > SHARD_WORDS):
                    yield from done()
                    shard, held, total = shard + 1, [], 0
                held.append((id_, Counter(words), len(words)))
                total += len(words)
        if held:
            yield from done()

    content = docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text"))
    whole = materialize(content.mapInArrow(built, f"{INDEX}, keys array<{kind}>, lengths array<int>"), "ball-index")
    return whole.filter("term is not null").drop("keys", "lengths"), whole.filter("term is null").select("shard", "keys", "lengths")


# --- the tree of a shard --------------------------------------------------------------------


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


class BallTree:
    """Documents as sparse vectors: ``values`` (integers) at ``docs`` and ``terms``; ``weights`` by term scale the space of the balls."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray) -> None:
        self.scale = np.sqrt(weights.astype(np.float64))
        self.ids, local = np.unique(docs, return_inverse=True)  # documents without asked terms score nothing
        spread = values * self.scale[terms]
        directions = np.random.default_rng(len(weights)).standard_normal((DIRECTIONS, len(weights)))
        sketch = np.stack([np.bincount(local, spread * d[terms], minlength=len(self.ids)) for d in directions], axis=1)
        order = self._halve(sketch)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.ids, at = self.ids[order], place[local]
        self.leaf_starts = np.array([low for low, end, left, _ in self.nodes if left < 0] + [len(order)])
        self.leaf_starts.sort()
        leaf = np.searchsorted(self.leaf_starts, at, side="right") - 1
        by_leaf = np.lexsort((at, terms, leaf))
        self.at, self.terms, self.values, leaf = at[by_leaf], terms[by_leaf], values[by_leaf], leaf[by_leaf]
        runs = np.flatnonzero(np.diff(self.terms, prepend=-1) | np.diff(leaf, prepend=-1))  # one for each term of each leaf
        self.run_ends, self.run_starts = np.append(runs[1:], len(leaf)), runs
        self.run_terms, run_leaf = self.terms[runs], leaf[runs]
        self.leaf_runs = np.searchsorted(run_leaf, np.arange(len(self.leaf_starts)))
        sums = np.add.reduceat(spread[by_leaf], runs)
        by_term = np.argsort(self.run_terms, kind="stable")
        self.sums, self.sum_leaf = sums[by_term], run_leaf[by_term]
        self.term_sums = np.searchsorted(self.run_terms[by_term], np.arange(len(weights) + 1))
        self._measure(spread[by_leaf])

    def _halve(self, sketch: np.ndarray) -> np.ndarray:
        """Sets ``nodes`` (first, end, left child, right child); the order of the documents in the leaves."""
        order, self.nodes, todo = np.arange(len(sketch)), [], [(0, len(sketch), -1, 0)]
        while todo:
            low, end, parent, side = todo.pop()
            me = len(self.nodes)
            self.nodes.append([low, end, -1, -1])
            if parent >= 0:
                self.nodes[parent][2 + side] = me
            if end - low > LEAF:
                mine = sketch[order[low:end]]
                middle = (end - low) // 2
                one = mine[((mine - mine.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                other = mine[((mine - one) ** 2).sum(axis=1).argmax()]
                order[low:end] = order[low:end][np.argpartition(mine @ (other - one), middle)]
                todo += [(low + middle, end, me, 1), (low, low + middle, me, 0)]
        return order

    def _measure(self, spread: np.ndarray) -> None:
        """Radii of all nodes; the nodes of one depth are measured together."""
        self.radius = np.zeros(len(self.nodes))
        square = np.bincount(self.at, spread**2, minlength=len(self.ids))
        level = [0]
        while level:
            level.sort(key=lambda x: self.nodes[x][0])
            starts = np.array([self.nodes[x][0] for x in level])
            ends = np.array([self.nodes[x][1] for x in level])
            node = np.searchsorted(starts, self.at, side="right") - 1
            inside = (node >= 0) & (self.at < ends[node])  # leaves that ended higher up leave gaps
            node, at, value = node[inside], self.at[inside], spread[inside]
            cell, back = np.unique(node * len(self.scale) + self.terms[inside], return_inverse=True)
            centroid = np.bincount(back, value) / (ends - starts)[cell // len(self.scale)]
            length = np.bincount(cell // len(self.scale), centroid**2, minlength=len(level))
            product = np.bincount(at, value * centroid[back], minlength=len(self.ids))
            for x, low, end, c in zip(level, starts, ends, length, strict=True):
                apart = square[low:end] - 2 * product[low:end] + c
                self.radius[x] = np.sqrt(max(0.0, apart.max()) + ROUNDING * (square[low:end].max() + c))
            level = [c for x in level for c in self.nodes[x][2:] if c >= 0]

    def bounds(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What no document of each node can exceed."""
        query = counts * self.scale[terms]
        starts, ends = self.term_sums[terms], self.term_sums[terms + 1]
        which = _ranges(starts, ends)
        by_leaf = np.bincount(self.sum_leaf[which], self.sums[which] * np.repeat(query, ends - starts), minlength=len(self.leaf_starts) - 1)
        upto = np.concatenate(([0.0], np.cumsum(by_leaf)))
        low, end = (np.array([x[i] for x in self.nodes]) for i in (0, 1))
        first, last = (np.searchsorted(self.leaf_starts, x) for x in (low, end))
        reach = self.radius * np.sqrt((query**2).sum())
        return (upto[last] - upto[first]) / (end - low) + reach + ROUNDING * (upto[-1] + reach) + 1

    def scores(self, leaf: int, terms: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Exact scores of the documents of a leaf; ``terms`` ascend."""
        out = np.zeros(self.leaf_starts[leaf + 1] - self.leaf_starts[leaf], dtype=np.int64)
        low, end = self.leaf_runs[leaf], self.leaf_runs[leaf + 1]
        mine = self.run_terms[low:end]
        run = np.searchsorted(mine, terms)
        there = mine[np.minimum(run, len(mine) - 1)] == terms
        run = run[there] + low
        which = _ranges(self.run_starts[run], self.run_ends[run])
        factor = np.repeat(factors[there], self.run_ends[run] - self.run_starts[run])
        np.add.at(out, self.at[which] - self.leaf_starts[leaf], self.values[which] * factor)
        return out

    def search(self, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the ``k`` best documents with a score above 0; equal scores by number."""
        order = np.argsort(terms)
        terms, counts, factors = terms[order], counts[order], (counts * weights)[order]
        bounds = self.bounds(terms, counts).tolist()
        best: list[tuple[int, int]] = []  # (score, -document), the worst first
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heappop(todo)
            if len(best) == k and -bound < best[0][0]:
                break
            low, _, left, right = self.nodes[node]
            if left >= 0:
                heappush(todo, (-bounds[left], left))
                heappush(todo, (-bounds[right], right))
                continue
            scores = self.scores(int(np.searchsorted(self.leaf_starts, low)), terms, factors)
            for i in np.flatnonzero(scores >= (best[0][0] if len(best) == k else 1)).tolist():
                entry = (int(scores[i]), -int(self.ids[low + i]))
                if len(best) < k:
                    heappush(best, entry)
                elif entry > best[0]:
                    heapreplace(best, entry)
        return [(score, -doc) for score, doc in best]


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What the occurrences of a term make of its weight in documents of that many terms; 64-bit integers."""
    m = np.array([25 + 75 * n * n_docs // n_words for n in lengths.tolist()], dtype=np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


# --- the operator ---------------------------------------------------------------------------


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = [Counter(words_of(t)) for t in batch["text"]]
        yield pd.DataFrame(
            {
                "number": np.repeat(batch["number"].to_numpy(), [len(c) for c in counts]),
                "term": pd.Series([t for c in counts for t in c], dtype=object),
                "times": np.array([n for c in counts for n in c.values()], dtype=np.int64),
            }
        )


def search(
    index: DataFrame, shards: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """(query id, key, rank, score): the ``k`` best documents of each row of ``queries``.

    With N documents that have terms, L their terms and df the documents with a term, a term
    weighs floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n terms, tf of them this one,
    gets that times (10**9 tf) div (1000 tf + 8 m), m being 25 + (75 n N) div L, for each time
    that the query has the term. Only scores above 0 count; equal scores go by key, null keys last.
    Rows of ``queries`` with one id are one text; null and empty texts have no results.
    """
    spark = queries.sparkSession
    key_type, query_type = shards.schema["keys"].dataType.elementType.simpleString(), queries.schema[query_id].dataType.simpleString()
    size = F.sum(F.size(F.filter("lengths", lambda n: n > 0))).alias("docs")
    words = F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("words")
    n_docs, n_words = shards.agg(size, words).first()
    if not n_words:
        return spark.createDataFrame([], f"{query_id} {query_type}, key {key_type}, rank int, score long")
    numbered = materialize(queries.select(F.col(f"`{query_id}`").alias("query"), text_or_empty(text).alias("text")), "asked-texts")
    ids = materialize(numbered.select("query").distinct().withColumn("number", F.monotonically_increasing_id()), "asked-ids")
    n_blocks = -(-max(1, ids.count()) // QUERIES)
    texts = numbered.join(ids, numbered["query"].eqNullSafe(ids["query"])).select("number", "text")
    counted = texts.mapInPandas(_asked, "number long, term binary, times long").groupBy("number", "term").agg(F.sum("times").alias("times"))
    asked = materialize(counted.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n_blocks))), "asked-terms")
    wanted = materialize(index.join(asked.select("term").distinct(), "term", "left_semi"), "wanted-postings")
    df = wanted.groupBy("term").agg(F.sum(F.size("ids")).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = asked.join(df, "term").select("block", "number", "term", "times", weight.alias("weight"))
    # A query is one line here: its own terms.
    lines = weighted.groupBy("block", "number").agg(F.collect_list(F.struct("term", "times", "weight")).alias("asked"))
    every = shards.select("shard", "lengths", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")).alias("block"))
    right = salted_join(every.select("shard", "block"), lines, ["block"], spread=["shard"], how="inner")
    posted = wanted.join(asked.select("block", "term").distinct(), "term").select("shard", "block", "term", "ids", "counts")
    left = posted.unionByName(every.select("shard", "block", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("array<int>").alias("ids"), F.col("lengths").alias("counts")))

    def searched(key: tuple, held: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        about = held["term"].isna()
        posted = held[~about]
        if len(posted) and len(lines):
            lengths = np.asarray(held.loc[about, "counts"].iloc[0], dtype=np.int64)
            names = {bytes(t): i for i, t in enumerate(posted["term"])}
            docs = np.concatenate(posted["ids"].to_list()).astype(np.int64)
            terms = np.repeat(np.arange(len(posted)), posted["ids"].map(len))
            counts = np.concatenate(posted["counts"].to_list()).astype(np.int64)
            asked = [[(names[bytes(a["term"])], a["times"], a["weight"]) for a in line if bytes(a["term"]) in names] for line in lines["asked"]]
            weights = np.zeros(len(posted), dtype=np.int64)
            for line in asked:
                for term, _, weight in line:
                    weights[term] = weight
            tree = BallTree(docs, terms, impacts(counts, lengths[docs], n_docs, n_words), weights)
            for number, line in zip(lines["number"], asked, strict=True):
                if line:
                    found += [(number, key[0], doc, score) for score, doc in tree.search(*np.array(line, dtype=np.int64).T, k)]
        return pd.DataFrame(found, columns=["number", "shard", "doc", "score"]).astype("int64")

    local = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(searched, "number long, shard long, doc long, score long")
    # Keys first, as equal scores go by them.
    keyed = local.join(shards.select("shard", "keys"), "shard").select("number", "score", F.get("keys", F.col("doc").cast("int")).alias("key"))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = keyed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(ids, "number").select(F.col("query").alias(query_id), "key", "rank", "score")
