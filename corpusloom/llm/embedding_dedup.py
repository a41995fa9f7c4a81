"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with a cosine of at least c differ by a squared distance of at most 2 - 2c. They
are rotated and cut into blocks of few dimensions; each block gets the share of that budget
which its dimensions have of all. In at least one block two near vectors keep the budget: else
their distance were larger. So each block is joined by range, and the union of what the
blocks find is verified by the cosine itself.

The range join of a block works on orthants of its first dimensions. A vector lives in the orthant of its own
signs and visits every orthant of a greater number that lies within the budget's radius, so
that any two vectors within the radius meet in exactly one orthant, where at least one of
them lives. A pair near in several blocks counts in the first of them only. Tasks return
sums per vector and a forest of links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing, materialize
from corpusloom.llm.components import components
from corpusloom.session import salted_join

by_value(__name__)

MIN_COSINE = 0.98
#: Dimensions of a block, at most, and how many of them cut it into orthants.
BLOCK_DIMS, CUT_DIMS = 8, 5
#: Vectors of one orthant that are compared at once; larger orthants are compared in pairs of such parts.
PART = 1024
#: Vectors on either side of a tile, and pairs that are verified at once.
TILE, PAIRS = 512, 16384
#: What rounding may add to a squared distance of unit vectors, and to one that a matrix product gives.
ROUNDING, PRODUCT_ROUNDING = 1e-10, 1e-7
OUTPUT = ("n_links", "component_id", "kept")


# --- geometry; sums run in a fixed order, so that a pair has the same figures in every task ----


def _row_sums(columns: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n)
    for column in columns:
        total += column
    return total


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; no row may be zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt(_row_sums((scaled**2).T, len(scaled)))[:, None]


def rotation(dims: int) -> np.ndarray:
    """An orthogonal matrix: random signs, then the discrete Hartley transform."""
    k = np.arange(dims)
    angle = 2 * np.pi * (np.outer(k, k) % dims) / dims
    signs = np.random.default_rng(dims).choice([-1.0, 1.0], dims)
    return signs[:, None] * (np.cos(angle) + np.sin(angle)) / np.sqrt(dims)


def rotate(units: np.ndarray, low: int = 0, end: int | None = None) -> np.ndarray:
    """The rotated vectors, or some dimensions of them."""
    matrix = rotation(units.shape[1])[:, low:end]
    out = np.zeros((len(units), matrix.shape[1]))
    for column, row in zip(units.T, matrix, strict=True):
        out += column[:, None] * row
    return out


def blocks_of(dims: int) -> list[tuple[int, int]]:
    """(first dimension, end) of the blocks, as equal as can be."""
    edges = np.linspace(0, dims, -(-dims // BLOCK_DIMS) + 1).astype(int).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def budgets(dims: int, min_cosine: float) -> list[float]:
    """The greatest squared distance that each block may have: its share of the whole."""
    return [(2 - 2 * min_cosine) * (end - low) / dims + ROUNDING for low, end in blocks_of(dims)]


# --- orthants -------------------------------------------------------------------------------


def _orthants(turned: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, orthant, whether the row lives there) for the coordinates of one block."""
    turned = turned[:, :CUT_DIMS]
    width = turned.shape[1]
    home = (turned >= 0) @ (1 << np.arange(width))
    crossed = np.arange(1 << width)
    price = turned**2 @ ((crossed[:, None] >> np.arange(width)) & 1).T.astype(float)
    reached = home[:, None] ^ crossed
    row, which = np.nonzero((price <= budget + ROUNDING) & (reached >= home[:, None]))
    return row, reached[row, which], which == 0


def _placed(batches: Iterator[pd.DataFrame], min_cosine: float) -> Iterator[pd.DataFrame]:
    """Every vector at the orthants where it lives or which it visits, block by block."""
    for batch in batches:
        sizes = batch["vector"].map(len)
        for dims in sorted(sizes.unique()):
            same = batch[sizes == dims]
            turned = rotate(unit_vectors(np.stack(same["vector"].to_list()).astype(np.float64)))
            for block, ((low, end), budget) in enumerate(zip(blocks_of(dims), budgets(dims, min_cosine), strict=True)):
                row, orthant, home = _orthants(turned[:, low:end], budget)
                yield same.iloc[row].assign(orthant=orthant | block << BLOCK_DIMS | int(dims) << 32, home=home)


def _dealt(placed: DataFrame) -> DataFrame:
    """``placed`` by orthant and pair of parts (a, b); ``mine`` is a row's own part."""
    group = ["label", "orthant"]
    large = placed.groupBy(*group).count().filter(F.col("count") > PART)
    return (
        placed.join(large, group, "left")
        .withColumn("parts", F.coalesce(F.ceil(F.col("count") / PART), F.lit(1)).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(*placed.columns, "mine", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
        .repartition(*group, "a", "b")
        .sortWithinPartitions(*group, "a", "b")
    )


def _whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of a partition that is sorted ``by`` their keys, many groups at a time but each of them whole."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = (batch[by] == batch[by].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the members ``i`` and ``j`` in ``root``, which names the least member of each set."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


class _Members:
    """Members of many orthants, all of the same number of dimensions, in the order of their groups."""

    def __init__(self, frame: pd.DataFrame, dims: int, min_cosine: float) -> None:
        self.min_cosine = min_cosine
        self.units = unit_vectors(np.stack(frame["vector"].to_list()).astype(np.float64))
        self.blocks, self.budgets = blocks_of(dims), budgets(dims, min_cosine)
        self.block = ((frame["orthant"].to_numpy() & 0xFFFFFFFF) >> BLOCK_DIMS).astype(int)
        self.own = np.zeros((len(frame), BLOCK_DIMS))
        for block in np.unique(self.block):
            low, end = self.blocks[block]
            here = self.block == block
            self.own[here, : end - low] = rotate(self.units[here], low, end)
        self.home = frame["home"].to_numpy(dtype=bool)
        self.mine, self.a, self.b = (frame[c].to_numpy() for c in ("mine", "a", "b"))

    def candidates(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a group that may keep its block's budget, one of them at home."""
        block, one = self.block[low], self.a[low] == self.b[low]
        own = self.own[low:high]
        square, home = (own**2).sum(axis=1), self.home[low:high]
        left, right = (np.flatnonzero(self.mine[low:high] == part) for part in (self.a[low], self.b[low]))
        for at in range(0, len(left), TILE):
            i = left[at : at + TILE]
            for to in range(at if one else 0, len(right), TILE):
                j = right[to : to + TILE]
                near = square[i][:, None] + square[j] - 2 * (own[i] @ own[j].T) <= self.budgets[block] + PRODUCT_ROUNDING
                near &= home[i][:, None] | home[j]
                if one and at == to:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                for cut in range(0, len(x), PAIRS):
                    yield low + i[x[cut : cut + PAIRS]], low + j[y[cut : cut + PAIRS]]

    def within(self, block: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs keep the budget of a block."""
        rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        turned = self.own[rows] if block == self.block[rows[:1]] else rotate(self.units[rows], *self.blocks[block])
        apart = turned[at[: len(i)]] - turned[at[len(i) :]]
        return _row_sums((apart**2).T, len(i)) <= self.budgets[block]

    def links(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs of a group whose first near block is this one."""
        for i, j in self.candidates(low, high):
            for block in range(self.block[low], -1, -1):
                if len(i):
                    keep = self.within(block, i, j) == (block == self.block[low])
                    i, j = i[keep], j[keep]
            if len(i):
                near = _row_sums((self.units[i] * self.units[j]).T, len(i)) >= self.min_cosine
                if near.any():
                    yield i[near], j[near]


def _links(batches: Iterator[pd.DataFrame], min_cosine: float) -> Iterator[pd.DataFrame]:
    """(u, v, gained): per member how many rows it is linked to (v = u), and a forest of links (gained = 0)."""
    by = ["label", "orthant", "a", "b"]
    for whole in _whole_groups(batches, by):
        dims_of = whole["orthant"].to_numpy() >> 32
        for dims in np.unique(dims_of).tolist():
            frame = whole[dims_of == dims]
            node, rows = frame["node"].to_numpy(), frame["rows"].to_numpy()
            members = _Members(frame, dims, min_cosine)
            gained, root = np.zeros(len(frame), dtype=np.int64), np.arange(len(frame))
            keys = frame[by]
            starts = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy())
            ends = np.append(starts[1:], len(frame))
            busy = ends - starts > 1
            for low, high in zip(starts[busy].tolist(), ends[busy].tolist(), strict=True):
                own = np.arange(high - low)
                for i, j in members.links(low, high):
                    np.add.at(gained, i, rows[j])
                    np.add.at(gained, j, rows[i])
                    _merge(own, i - low, j - low)
                root[low:high] = low + own
            some, child = gained > 0, root != np.arange(len(frame))
            if some.any():
                yield pd.DataFrame(
                    {
                        "u": np.concatenate([node[some], node[child]]),
                        "v": np.concatenate([node[some], node[root[child]]]),
                        "gained": np.concatenate([gained[some], np.zeros(child.sum(), dtype=np.int64)]),
                    }
                )


# --- the operator ---------------------------------------------------------------------------


def comparable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, only finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """Every row of ``vectors``, without the vector, with ``n_links``, ``component_id`` and ``kept``.

    Rows of equal label (not null) and equally many dimensions are linked if the cosine of their
    vectors, in double precision, is at least ``min_cosine``; the join is exact. ``n_links``
    counts the other rows that a row is linked to, copies among them. ``component_id`` is the
    least ``key`` of all rows that links reach, null keys last; ``kept`` says whether it is the
    row's own, so rows that repeat one key are kept or not together. A row with a null label or a
    vector that is null, empty, zero or has a null or non-finite component is linked with
    nothing. Equal vectors of a label are one node. Input columns named like an added one are replaced.
    """
    if not 0 <= min_cosine <= 1:
        raise ValueError("a cosine from 0 to 1 is asked for")
    kept = [c for c in drop_clashing(vectors, *OUTPUT).columns if c != vector]
    content = F.col(f"`{vector}`")
    rows = materialize(
        vectors.select(
            *(F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(kept)),
            F.col(f"`{key}`").alias("key"),
            F.when(F.col(f"`{label}`").isNotNull() & comparable(content), F.col(f"`{label}`").cast("string")).alias("label"),
            content.alias("vector"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "vectors",
    )
    first = F.min(F.struct(F.col("key").isNull(), F.col("key").alias("key"))).alias("least")
    nodes = materialize(
        rows.filter("label is not null").groupBy("label", "vector").agg(F.min("node").alias("node"), F.count("*").alias("rows"), first),
        "nodes",
    )
    members = nodes.select("label", "vector", "node", "rows")
    kind = f"label string, vector {rows.schema['vector'].dataType.simpleString()}, node long, rows long, orthant long, home boolean"
    placed = materialize(members.mapInPandas(lambda b: _placed(b, min_cosine), kind), "orthants")
    found = materialize(_dealt(placed).mapInPandas(lambda b: _links(b, min_cosine), "u long, v long, gained long"), "links")
    gained = found.groupBy(F.col("u").alias("node")).agg(F.sum("gained").alias("gained"))
    reached = nodes.join(gained, "node", "left").join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = reached.groupBy("root").agg(F.min("least").alias("one"))
    # One component may hold a large share of all nodes, and one vector a large share of all rows.
    labels = salted_join(reached, named, ["root"], spread=["node"]).select(
        "label", "vector", (F.coalesce("gained", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.col("one.key").alias("least")
    )
    joined = salted_join(rows, labels, ["label", "vector"], spread=["node"])
    component = F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("least"))
    return joined.select(
        *(F.col(f"in{i}").alias(c) for i, c in enumerate(kept)),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
