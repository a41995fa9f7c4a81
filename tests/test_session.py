from __future__ import annotations

from corpusloom.session import fresh_path, matching_paths, materialize, salted_join, shared_dir, working_tables


def test_salted_join_is_a_join(spark):
    left = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 10)) as k")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert sorted(map(str, salted_join(left, right, ["k"], ["id"], how).collect())) == want


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))


def test_materialize_prunes(spark):
    df = materialize(spark.range(10).selectExpr("id", "repeat('x', 100) as body"), "t")
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and df.count() == 10


def test_working_tables_go_at_the_end_of_their_block(spark):
    with working_tables(spark) as store:
        stored = store(spark.range(10), "t")
        kept = materialize(stored.selectExpr("id + 1 AS id"), "kept")
        folder = stored.inputFiles()[0].rsplit("/", 2)[0]
        assert matching_paths(spark, folder)
    assert not matching_paths(spark, folder) and kept.count() == 10
