from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF

from corpusloom.llm import embedding_dedup as ed
from corpusloom.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label string, kept string, N_links int"


def usable(v, label):
    return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, least):
    """(n_links, component_id) of each row by comparing all pairs."""
    scaled = [np.array(v) / max(abs(x) for x in v) if usable(v, label) else None for _, v, label in rows]
    units = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    near = [
        [
            j
            for j in range(len(rows))
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
            and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least
        ]
        for i in range(len(rows))
    ]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(keys) if keys else None))
    return sorted(out, key=str)


def planted(seed, dims, n):
    """Vectors of several kinds: alone, in tight groups, in chains whose ends are far, copies, scaled copies."""
    rng = np.random.default_rng(seed)
    rows = []

    def add(v, label):
        rows.append((len(rows), [float(x) for x in v], label))

    for _ in range(n):
        add(rng.standard_normal(dims), str(rng.integers(3)))
    for _ in range(4):
        center, label = rng.standard_normal(dims), str(rng.integers(3))
        for _ in range(n // 8):
            add(center + 0.08 * rng.standard_normal(dims), label)
    a, b = rng.standard_normal((2, dims))
    for step in np.linspace(0, 1, 25):
        add((1 - step) * a + step * b, "0")
    for row in rows[:20]:
        add(row[1], row[2])
        add([3 * x for x in row[1]], row[2])
    return rows


@pytest.mark.parametrize(("dims", "part", "least"), [(64, 1024, 0.98), (19, 16, 0.98), (8, 1024, 0.9), (3, 64, 0.99), (1, 1024, 0.98)])
def test_against_brute_force(spark, monkeypatch, dims, part, least):
    monkeypatch.setattr(ed, "PART", part)
    monkeypatch.setattr(ed, "TILE", 32)
    rows = planted(dims, dims, 120)
    got = ed.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5), min_cosine=least).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == brute(rows, least)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert max(r.n_links for r in got) > 2


def test_edges(spark):
    rows = [
        (1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "a"), (2, [1.0, 2.0], "a"), (3, [1.0, 2.0], "b"), (4, [1.0, 2.0], None), (5, None, "a"),
        (6, [], "a"), (7, [0.0, 0.0], "a"), (8, [1.0, None], "a"), (9, [math.nan, 1.0], "a"), (10, [math.inf, 1.0], "a"),
        (None, [1.0, 2.0], "a"), (None, [5.0, -1.0], "a"), (11, [1e200, 2e200], "a"), (12, [1e-200, 2e-200], "a"), (13, [1.0, 2.0, 0.0], "a"),
        (14, [-1.0, -2.0], "a"), (15, [-0.0, 1.0], "c"), (16, [0.0, 1.0], "c"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = ed.near_vectors(frame)
    assert sorted(c.lower() for c in out.columns) == ["component_id", "kept", "label", "n_links", "vec_id"]
    got = out.collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == brute(rows, 0.98)
    assert {r.vec_id for r in got if not r.kept} == {2, None, 11, 12, 16}
    alone = [r for r in got if r.vec_id is None and r.component_id is None]
    assert [r.kept for r in alone] == [True]
    assert ed.near_vectors(frame.limit(0)).collect() == []


def test_pairs_at_the_threshold(spark):
    """Angles just on either side of the limit."""
    limit = math.acos(0.98)
    rows = [(0, [1.0, 0.0] + [0.0] * 14, "a")]
    for i, turn in enumerate([limit - 1e-9, limit + 1e-9, limit - 1e-6, limit + 1e-6], 1):
        v = [0.0] * 16
        v[0], v[1 + i] = math.cos(turn), math.sin(turn)
        rows.append((i, v, "a"))
    got = {r.vec_id: r.n_links for r in ed.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()}
    assert [got[i] for i in range(1, 5)] == [1, 0, 1, 0]


def test_query_against_sql(spark, tmp_path):
    rows = planted(5, 16, 60)
    spark.createDataFrame([(i, v, int(label)) for i, v, label in rows], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    for folder, files in ((SF, f"{SF}/embeddings.parquet"), (str(tmp_path), f"{tmp_path}/embeddings.parquet/*.parquet")):
        db = duckdb.connect()
        db.sql(f"create view embeddings as select * from '{files}'")
        want = db.sql(ORACLES["op11_embedding_dedup"]).fetchall()
        got = QUERIES["op11_embedding_dedup"](spark, folder).select("vec_id", "n_links", "component_id", "kept")
        assert sorted(map(tuple, got.collect())) == sorted(want)
