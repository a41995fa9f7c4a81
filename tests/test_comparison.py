from __future__ import annotations

import hashlib
import random
from decimal import Decimal

import pytest

from corpusloom.operators import comparison as cp
from corpusloom.operators.history import as_of

LISTS = "workspace_id string, strategy_id string, scenario_id string, ndcg double"


def brute(rows, rounds, seed="0"):
    """Mean, p-value and interval of each pair, from the definitions."""
    limits = cp.poisson_limits()
    out = {}
    for w in {r[0] for r in rows}:
        names = sorted({r[1] for r in rows if r[0] == w})
        for a in names:
            for b in names:
                of = {s: {r[2]: Decimal(str(round(r[3], 9))) for r in rows if r[:2] == (w, s)} for s in (a, b)}
                both = sorted(set(of[a]) & set(of[b]))
                if a >= b or not both:
                    continue
                d = [of[b][s] - of[a][s] for s in both]
                far, means = 1, []
                for i in range(1, rounds + 1):
                    digits = [hashlib.md5(f"{seed}|{w}|{s}|{i}".encode()).hexdigest() for s in both]
                    far += abs(sum(x if h[0] < "8" else -x for x, h in zip(d, digits, strict=True))) >= abs(sum(d))
                    weights = [sum(h[1 : 1 + cp.DIGITS] >= limit for limit in limits) for h in digits]
                    total = sum(weights)
                    means.append(float(sum(x * n for x, n in zip(d, weights, strict=True))) / total if total else 0.0)
                means.sort()
                cut = int(rounds * cp.OUTSIDE / 2)
                out[w, a, b] = (len(d), float(sum(d)) / len(d), far / (rounds + 1), means[cut], means[rounds - cut - 1])
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_against_the_definitions(spark, partitions):
    rng = random.Random(4)
    rows = [(w, s, f"q{i}", round(min(1.0, rng.random() * 0.4 + shift), 6)) for w in ("w0", "w1") for s, shift in (("a", 0.3), ("b", 0.35), ("c", 0.3)) for i in range(25)]
    rows += [("w1", "d", "q1", 0.5), ("w2", "a", "q1", 0.5)]
    found = cp.compare_strategies(spark.createDataFrame(rows, LISTS).repartition(partitions), ["ndcg"], rounds=120)
    got = {(r.workspace_id, r.strategy_a, r.strategy_b): (r.scenarios, r.difference, r.p_value, r.low, r.high) for r in found.collect()}
    want = brute(rows, 120)
    assert got.keys() == want.keys() and len(got) == 9
    for pair, numbers in want.items():
        assert got[pair] == pytest.approx(numbers, abs=1e-9)
        assert got[pair][3] <= got[pair][4]


def test_clear_and_absent_differences(spark):
    rows = [("w", s, f"q{i}", v) for i in range(30) for s, v in (("a", 0.2), ("b", 0.9), ("c", 0.2))]
    found = {(r.strategy_a, r.strategy_b): r for r in cp.compare_strategies(spark.createDataFrame(rows, LISTS), ["ndcg"]).collect()}
    assert found["a", "b"].p_value < 0.01 and found["a", "b"].low > 0.6
    assert found["a", "c"].p_value == 1 and found["a", "c"].low == found["a", "c"].high == 0
    assert cp.compare_strategies(spark.createDataFrame([], LISTS), ["ndcg"]).collect() == []


def test_weights_are_poisson():
    limits = cp.poisson_limits()
    weights = [sum(hashlib.md5(str(i).encode()).hexdigest()[1 : 1 + cp.DIGITS] >= limit for limit in limits) for i in range(20_000)]
    assert sum(weights) / len(weights) == pytest.approx(1, abs=0.03)
    assert weights.count(0) / len(weights) == pytest.approx(0.3679, abs=0.015)


def test_as_of(spark):
    rng = random.Random(2)
    history = [(rng.choice("abcd"), rng.randrange(30) if rng.random() < 0.95 else None, i, rng.choice([None, 1, 2, 3])) for i in range(150)] + [(None, 1, 900, 9)]
    rows = [(rng.choice("abcdex"), rng.randrange(-2, 32), i) for i in range(120)] + [("a", None, 500), (None, 5, 501)]
    found = as_of(
        spark.createDataFrame(rows, "k string, at int, id int").repartition(3),
        spark.createDataFrame(history, "k string, since int, seq int, rating int").repartition(4),
        ["k"], "at", "since", ["rating"], "seq",
    )
    assert found.columns == ["k", "at", "id", "rating"]
    want = {}
    for k, at, i in rows:
        known = [(s, q, r) for h, s, q, r in history if h == k and k is not None and s is not None and at is not None and s <= at]
        want[i] = max(known)[2] if known else None
    assert {r.id: r.rating for r in found.collect()} == want and set(want.values()) >= {None, 1, 2, 3}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
