from __future__ import annotations

import random

from corpusloom.operators import search, segments, sketches
from corpusloom.operators.tokens import postings_and_lengths
from corpusloom.session import materialize

DOCS = "doc_id long, text string"


def test_index_follows_upserts(spark, tmp_path):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choices([f"w{chr(97 + i)}" for i in range(12)], k=rng.randrange(0, 15)))
    corpus, root = {i: text() for i in range(60)}, str(tmp_path / "index")
    asked = spark.createDataFrame([(1, "wa wb wc"), (2, "wd we wd"), (3, "none")], "query_id long, text string")

    def check(folder):
        live = segments.live_postings(spark, folder)
        frame = spark.createDataFrame(list(corpus.items()), DOCS)
        assert sorted(live.collect(), key=str) == sorted(postings_and_lengths(frame, "text").select(*live.columns).collect(), key=str)
        terms = search.query_terms(asked, "text")
        got = search.bm25_topk(materialize(live, "live"), terms, 5).collect()
        assert sorted(got) == sorted(search.search(frame, asked, 5).collect()) and got

    segments.add_segment(spark.createDataFrame(list(corpus.items()), DOCS), root, "text")
    check(root)
    for step in range(3):
        changed = {i: text() for i in rng.sample(range(80 + step), 12)}
        gone = [i for i in rng.sample(range(80), 8) if i not in changed]
        segments.add_segment(spark.createDataFrame(list(changed.items()), DOCS), root, "text", spark.createDataFrame([(i,) for i in gone], "doc_id long"))
        corpus = {i: t for i, t in (corpus | changed).items() if i not in gone}
        check(root)
    merged = str(tmp_path / "merged")
    segments.merge_segments(spark, root, merged)
    check(merged)
    assert segments._numbers(spark, merged) == [0] and segments._numbers(spark, root) == [0, 1, 2, 3]
    corpus[500] = "wa wa"
    assert segments.add_segment(spark.createDataFrame([(500, "wa wa")], DOCS), merged, "text") == 1
    check(merged)


def test_incomplete_segments_do_not_count(spark, tmp_path):
    root = str(tmp_path / "index")
    segments.add_segment(spark.createDataFrame([(1, "a b")], DOCS), root, "text")
    spark.createDataFrame([(1,)], "doc_id long").write.parquet(f"{root}/keys/segment=00000001")  # a load that was lost
    assert segments.live_postings(spark, root).count() == 3


def test_sketches_merge(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice("xyz"), int(rng.paretovariate(0.4)) % 3000) for _ in range(20_000)] + [("a", "x", None)]
    frame = spark.createDataFrame(rows, "l1 string, l2 string, v long")
    parts = [sketches.sketch_leaves(frame.filter(c), ["l1", "l2"], "v") for c in ("v % 2 = 0", "v % 2 = 1")]
    both = sketches.merge_up(parts[0].unionByName(parts[1]), ["l1"])
    for r in sketches.estimates(both, ["l1"], 5).collect():
        mine = [v for a, _, v in rows if a == r.l1 and v is not None]
        assert r.rows == len(mine)
        assert abs(r.n_distinct - len(set(mine))) <= max(1, sketches.DEVIATIONS * sketches.HLL_ERROR * len(set(mine)))
        assert abs(r.n - mine.count(r.value)) <= 3.5 * len(mine) / sketches.TRACKED + 1


def test_postings_of_asked_terms(spark):
    """A search used to count and move the postings of every term of the corpus."""
    from corpusloom.operators import tokens
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a b b c"), (2, "c c"), (3, ""), (4, None), (None, "b"), (2, "c d")], "doc_id long, text string")
    asked = spark.createDataFrame([("b",), ("c",), ("x",)], "term string")
    rows = lambda df: sorted(map(str, df.collect()))
    every = tokens.postings_and_lengths(docs, "text")
    assert rows(tokens.postings_and_lengths(docs, "text", terms=asked)) == rows(every.filter(F.col("term").isNull() | F.col("term").isin("b", "c")))
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(doc_id" in plan
