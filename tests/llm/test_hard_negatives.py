from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF
from pyspark.sql import functions as F

from corpusloom.llm import hard_negatives as hn
from corpusloom.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label string, rank string, Norm int, is_anchor int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0) for r in rows], SCHEMA)


def brute(rows, anchors, positives=5, negatives=3):
    rows = [
        (i, id_, [math.floor(256 * x) for x in v], label)
        for i, (id_, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []

    def order(score, id_):
        return (-score, id_ is None, id_ or 0)

    for i, id_, v, label in rows:
        if id_ is None or not anchors(id_):
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=False)), other, mine == label) for j, other, w, mine in rows if j != i]
        best = sorted((order(s, o), s, o) for s, o, same in scored if same)[:positives]
        for _, ps, positive in best:
            hits = sorted((order(s, o), s, o) for s, o, same in scored if not same and 50 * ps <= 100 * s <= 95 * ps)[:negatives]
            out += [(id_, positive, rank + 1, o, ps, s) for rank, (_, s, o) in enumerate(hits)]
    return sorted(out, key=str)


def found(df):
    out = hn.mine_hard_negatives(df, F.col("vec_id") % 10 == 0)
    return sorted([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect()], key=str)


def vectors(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((12, dims))
    rows = []
    for i in range(n):
        v = (centers[rng.integers(12)] + spread * rng.standard_normal(dims)) * rng.choice([0.05, 0.2, 1.0])
        rows.append((i, [float(x) for x in v], str(rng.integers(4))))
    return rows + [(n + i, *rows[i * 2][1:]) for i in range(20)]  # ties


@pytest.mark.parametrize(("rows_", "anchors", "tile", "spread"), [(4096, 1024, 128, 1.0), (64, 7, 8, 0.2), (50, 1, 1, 0.01)])
def test_against_brute_force(spark, monkeypatch, rows_, anchors, tile, spread):
    for name, value in (("ROWS", rows_), ("ANCHORS", anchors), ("TILE", tile)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(tile, 300, 12, spread)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 50
    assert found(frame(spark, rows).repartition(4)) == want


def test_edges(spark):
    rows = vectors(9, 60, 4, 0.3)
    rows += [
        (100, None, "1"), (110, [], "1"), (120, [0.0] * 4, "1"), (130, [1.0, None, 0.0, 0.0], "1"), (140, [math.nan] * 4, "1"),
        (150, [math.inf, 0.0, 0.0, 0.0], "1"), (160, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], "1"), (None, [1.0, 1.0, 1.0, 1.0], "2"),
        (170, [1.0, 1.0], "1"), (180, [1.0] * 6, "2"), (190, [1e12, 1.0, 1.0, 1.0], "0"), (191, [1.1e12, 1.0, 1.0, 1.0], "0"), (192, [7e11, 1.0, 1.0, 1.0], "3"),
        (50, rows[50][1], rows[50][2]),
    ]
    # The products of the largest vectors are beyond a long, so only some of them are compared here.
    small = [r for r in rows if r[0] not in (190, 191, 192)]
    assert found(frame(spark, small)) == brute(small, lambda i: i % 10 == 0)
    assert found(frame(spark, rows))
    assert found(frame(spark, []).limit(0)) == []
    assert found(frame(spark, [(1, [1.0], "a")])) == []
    assert found(frame(spark, [(0, [], "a"), (1, [], "a"), (2, [], "b")])) == brute([(0, [], "a"), (1, [], "a"), (2, [], "b")], lambda i: i % 10 == 0)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [3e6, 1.0], "a"), (1, [3e6, 2.0], "a"), (2, [2e6, 1.5], "b"), (3, [2e6, 1.25], "b"), (4, [2e6 + 1 / 256, 0.0], "b"), (5, [1e6, 0.0], "b")]
    assert found(frame(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_bounds_hold_and_tiles_are_passed_over(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(1)
    centers = rng.standard_normal((10, 32)) * 200
    which = np.sort(rng.integers(0, 10, 2000))
    ints = np.floor(centers[which] + 5 * rng.standard_normal((2000, 32)))
    directions = hn.references(ints[::50])
    frame = pd.DataFrame({"vector": list(ints.astype(np.int64)), "row": range(2000), "key": range(2000), "no_key": False, "label": [str(i % 3) for i in range(2000)], "place": range(2000)})
    frame = next(hn._with_angles(iter([frame]), directions))
    anchors, rows = hn._sides(frame.iloc[::40], frame)
    least, most = hn._score_bounds(anchors, rows)
    exact = ints[::40] @ ints.T
    for tile, (low, end) in enumerate(zip(rows.starts, rows.ends, strict=True)):
        assert (exact[:, low:end].max(axis=1) <= most[:, tile]).all()
        assert (exact[:, low:end].min(axis=1) >= least[:, tile]).all()
    scored = []
    real = hn._scores
    monkeypatch.setattr(hn, "_scores", lambda a, which, *x: scored.append(len(which)) or real(a, which, *x))
    hn._positives(frame.iloc[::40], frame, 5)
    assert sum(scored) < 0.5 * 50 * len(rows.starts)


def test_query_against_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = sorted(db.sql(ORACLES["op13_hard_negatives"]).fetchall())
    got = QUERIES["op13_hard_negatives"](spark, SF).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(map(tuple, got.collect())) == want and want
