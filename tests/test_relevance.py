from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import relevance as rv

RATINGS = {("q1", 1): 3, ("q1", 2): 0, ("q1", 3): 1, ("q1", 9): 2, ("q2", 1): 0, ("q3", 5): 3}
HITS = {
    ("s", "q1"): [2, 3, 7, 1],
    ("s", "q2"): [1, 2],
    ("t", "q1"): [1, 9, 3],
    ("t", "q3"): [8],
    ("t", "q4"): [8, 5],
}
K, TOP = 4, 3


@pytest.fixture(scope="module")
def judged(spark):
    rows = [("w", q, "i", d, r) for (q, d), r in RATINGS.items()]
    rows += [("v", q, "i", d, 3 - r) for (q, d), r in RATINGS.items()]  # another workspace, of no concern
    return spark.createDataFrame(rows, "workspace_id string, scenario_id string, index string, doc_id long, rating int")


@pytest.fixture(scope="module")
def rated(spark, judged):
    rows = [("w", s, q, "i", d, 1.0 / n, n) for (s, q), docs in HITS.items() for n, d in enumerate(docs, 1)]
    hits = spark.createDataFrame(rows, "workspace_id string, strategy_id string, scenario_id string, index string, doc_id long, score double, rank int")
    return hits, rv.hits_left_judgements(hits, judged)


def wanted(strategy, scenario):
    ratings = [RATINGS.get((scenario, d)) or 0 for d in HITS[strategy, scenario]]
    known = sorted((r for (q, _), r in RATINGS.items() if q == scenario), reverse=True)
    dcg = lambda rs: sum((2**r - 1) / math.log2(n + 1) for n, r in enumerate(rs, 1))
    relevant = [r >= 1 for r in ratings]
    total, best = sum(r >= 1 for r in known), dcg(known[:K])
    err, reach = 0.0, 1.0
    for n, r in enumerate(ratings, 1):
        stop = (2**r - 1) / 2**TOP
        err += reach * stop / n
        reach *= 1 - stop
    return {
        "precision": sum(relevant) / len(ratings),
        "recall": sum(relevant) / total if total else 0.0,
        "mrr": 1 / (relevant.index(True) + 1) if any(relevant) else 0.0,
        "dcg": dcg(ratings),
        "ndcg": dcg(ratings) / best if best else 0.0,
        "err": err,
    }


def test_metrics(rated, judged):
    _, with_ratings = rated
    single = {
        "precision": rv.precision_at_k(with_ratings),
        "recall": rv.recall_at_k(with_ratings, judged),
        "mrr": rv.mrr_at_k(with_ratings),
        "dcg": rv.dcg_at_k(with_ratings),
        "ndcg": rv.ndcg_at_k(with_ratings, judged, K),
        "err": rv.err_at_k(with_ratings, TOP),
    }
    table = {(r.strategy_id, r.scenario_id): r for r in rv.metrics(with_ratings, judged, K, TOP).collect()}
    assert table.keys() == HITS.keys()
    for name, df in single.items():
        got = {(r.strategy_id, r.scenario_id): r[name] for r in df.collect()}
        for pair in HITS:
            assert got[pair] == pytest.approx(wanted(*pair)[name])
            assert table[pair][name] == pytest.approx(wanted(*pair)[name])
            assert name == "dcg" or 0 <= got[pair] <= 1
    summary = {r.strategy_id: r for r in rv.evaluation_summary(rv.metrics(with_ratings, judged, K, TOP)).collect()}
    assert summary[None].searches == 5
    assert summary["s"].mrr == pytest.approx((wanted("s", "q1")["mrr"] + wanted("s", "q2")["mrr"]) / 2)


def test_unrated(rated, judged):
    hits, _ = rated
    got = {r.doc_id: (r["count"], r.strategies, r.scenarios) for r in rv.unrated_docs(hits, judged).collect()}
    assert got == {7: (1, 1, 1), 2: (1, 1, 1), 8: (2, 1, 2), 5: (1, 1, 1)}
    assert rv.unrated_hits(hits, judged).count() == 5


def test_ideal_ranks_counts_not_rows(spark):
    judged = spark.range(3000).selectExpr("'w' as workspace_id", "'q' as scenario_id", "cast(id % 4 as int) as rating")
    assert rv.ideal_dcg(judged, 5).first().ideal == pytest.approx(sum(7 / math.log2(n + 1) for n in range(1, 6)))
    few = judged.filter("rating < 2").limit(3)
    assert rv.ideal_dcg(few.filter("rating = 1"), 50).count() <= 1


def test_ranked_hits(spark):
    docs = spark.range(100).selectExpr("'w' as workspace_id", "id as doc_id", "if(id % 3 = 0, 'hot', 'x') as lang", "id % 10 as len")
    df = rv.ranked_hits(docs, {"len": F.col("len"), "new": F.col("doc_id")}, 2, "lang", "i")
    got = {(r.strategy_id, r.scenario_id, r["rank"]): r.doc_id for r in df.collect()}
    assert got[("len", "hot", 1)] == 9 and got[("len", "hot", 2)] == 39
    assert got[("new", "x", 1)] == 98 and len(got) == 8


def test_judgement_lifecycle(spark):
    base = spark.createDataFrame(
        [("w", "q", "i", 1, 2, 10, "ann", "api", None, None, None)],
        "workspace_id string, scenario_id string, index string, doc_id long, rating int, created_at int, created_by string,"
        "created_via string, updated_at int, updated_by string, updated_via string",
    ).withColumn("_id", rv.judgement_id())
    delta = spark.createDataFrame(
        [("mine", "w", "q", "i", 1, 0, 20), ("mine", "w", "q", "i", 1, 3, 21), ("x", "w", "q", "i", 2, 1, 22)],
        "_id string, workspace_id string, scenario_id string, index string, doc_id long, rating int, at int",
    )
    out = rv.set_judgements(base, delta, "at", "bob")
    rows = {r.doc_id: r for r in out.collect()}
    first = rows[1]
    assert (first.rating, first.created_at, first.created_by, first.updated_at, first.updated_by) == (3, 10, "ann", 21, "bob")
    assert (rows[2].created_at, rows[2].created_by, rows[2].updated_at) == (22, "bob", None)
    assert len(first["_id"]) == 64 and "mine" not in {r["_id"] for r in rows.values()}
    assert [r.doc_id for r in rv.unset_judgements(out, out.filter("doc_id = 1")).collect()] == [2]


def test_validate_workspace(spark):
    df = spark.createDataFrame(
        [(1, "w", "0", "3"), (2, None, None, None), (3, "other", "0", "3"), (4, "w", "zero", "3"), (5, "w", "0", "")],
        "id int, workspace_id string, scale_min string, scale_max string",
    )
    accepted, rejected = rv.validate_workspace(df, "w")
    assert {tuple(r) for r in accepted.collect()} == {(1, "w", 0, 3), (2, "w", None, None)}
    assert {r.id: r.problem for r in rejected.collect()} == {
        3: "record of another workspace",
        4: "scale_min cannot be read as an integer",
        5: "scale_max cannot be read as an integer",
    }


def test_candidates(spark):
    scenarios = spark.createDataFrame(
        [("w", "a", ["x", "y"]), ("w", "b", ["y"]), ("w", "c", []), ("v", "d", ["x", "y"])],
        "workspace_id string, scenario_id string, params array<string>",
    )
    strategies = spark.createDataFrame(
        [("w", "s0", []), ("w", "s1", ["y"]), ("w", "s2", ["y", "x", "x"]), ("w", "s3", ["z"])],
        "workspace_id string, strategy_id string, params array<string>",
    )
    df = rv.select_candidates(scenarios, strategies)
    got = {(r.strategy_id, r.scenario_id) for r in df.collect()}
    assert got == {("s0", "a"), ("s0", "b"), ("s0", "c"), ("s1", "a"), ("s1", "b"), ("s2", "a")}
    assert "Cartesian" not in df._jdf.queryExecution().executedPlan().toString()
    tagged = spark.createDataFrame([("a", ["t"]), ("b", []), ("c", ["u"])], "scenario_id string, tags array<string>")
    assert {r.scenario_id for r in rv.choose(tagged, "scenario_id", ["b"], ["t"]).collect()} == {"a", "b"}
    assert rv.choose(tagged, "scenario_id").count() == 3


def test_candidates_with_empty_and_null_parameters(spark):
    lists = {"e": [], "n": None, "b": [""], "a": ["a"], "ba": ["", "a"]}
    scenarios = spark.createDataFrame([("w", k, v) for k, v in lists.items()], "workspace_id string, scenario_id string, params array<string>")
    strategies = spark.createDataFrame([("w", k, v) for k, v in lists.items()], "workspace_id string, strategy_id string, params array<string>")
    got = {(r.strategy_id, r.scenario_id) for r in rv.select_candidates(scenarios, strategies).collect()}
    assert got == {(s, q) for s, x in lists.items() for q, y in lists.items() if set(x or ()) <= set(y or ())}


def test_judgement_ids_do_not_collide(spark):
    rows = [("a|b", "c", "i", 1), ("a", "b|c", "i", 1), ("a", None, "b", 1), (None, "a", "b", 1), ("", "a", "b", 1), ("1:a", "", "", 1), ("1", ":a", "", 1)]
    df = spark.createDataFrame(rows, "workspace_id string, scenario_id string, index string, doc_id long")
    assert df.select(rv.judgement_id().alias("i")).distinct().count() == len(rows)


def test_sample_is_repeatable(spark):
    df = spark.range(500).selectExpr("cast(id as string) as scenario_id")
    pick = lambda d, seed: [r.scenario_id for r in rv.sample_scenarios(d, 20, seed).collect()]
    assert pick(df, "1") == pick(df.repartition(17), "1") != pick(df, "2")


def test_render(spark):
    df = spark.createDataFrame([('{"q":"{{a}}","x":{{b}},{{c}}}', {"a": "{{b}}", "b": "2", "": "no"})], "s string, v map<string,string>")
    assert df.select(rv.render_strategy(F.col("s"), F.col("v"))).first()[0] == '{"q":"{{b}}","x":2,{{c}}}'


def test_flatten_keeps_empties(spark):
    df = spark.createDataFrame(
        [(1, [("ok", [("t", ["r1", "r2"]), ("u", [])]), ("open", [])]), (2, None)],
        "id int, rounds array<struct<status:string, steps:array<struct<type:string, results:array<string>>>>>",
    )
    got = {tuple(r) for r in rv.flatten_conversations(df, ["id"]).collect()}
    assert got == {
        (1, 0, "ok", 0, "t", 0, "r1"),
        (1, 0, "ok", 0, "t", 1, "r2"),
        (1, 0, "ok", 1, "u", None, None),
        (1, 1, "open", None, None, None, None),
        (2, None, None, None, None, None, None),
    }


def test_queries_of_strategies_survive_json(spark):
    from corpusloom.plans.evaluation import strategy_queries

    text = 'a "quoted"\nline \\ {{turn}} é'
    scenarios = spark.createDataFrame([("w", "q", ["text"], {"text": text})], "workspace_id string, scenario_id string, params array<string>, values map<string,string>")
    strategies = spark.createDataFrame([("w", "s", ["text"], '{"q":"{{text}}"}', "simple")], "workspace_id string, strategy_id string, params array<string>, source string, analyzer string")
    assert strategy_queries(scenarios, strategies).collect() == [("w", "s", "q", "simple", text)]
