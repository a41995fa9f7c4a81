from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import hierarchy, taxonomy
from corpusloom.session import salted_join

PAGES = "page_id long, title string, ns int, redirect boolean, text string"
RULES = "rule_ord int, l1 string, l2 string, keyword string"


def edges_of(spark, parents: dict[str, list[str]]):
    rows = [(c, p, i) for c, ps in parents.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "child string, parent string, pos int")


def expected(direct, parents):
    """The rule in words: look up, leave out what is already there, keep the first place."""
    level1 = [p for c in direct for p in parents.get(c, [])]
    level2 = [g for p in level1 for g in parents.get(p, [])]
    out1 = list(dict.fromkeys(p for p in level1 if p not in direct))
    out2 = list(dict.fromkeys(g for g in level2 if g not in direct and g not in out1))
    return direct, out1, out2, list(dict.fromkeys(direct + out1 + out2))


def test_last_page_of_a_category_wins(spark):
    pages = spark.createDataFrame(
        [
            (9, "Category:c", 14, False, "[[Category:new]] [[Category:b]]"),
            (3, "Category:c", 14, False, "[[Category:old]]"),
            (12, "Category:c", 14, False, "no link, so no entry"),
            (13, "Category:c", 14, True, "[[Category:redirected]]"),
            (14, "c", 0, False, "[[Category:article]]"),
        ],
        PAGES,
    )
    rows = hierarchy.category_edges(pages).orderBy("pos").collect()
    assert [(r.child, r.parent, r.pos) for r in rows] == [("c", "new", 0), ("c", "b", 1)]
    counts = hierarchy.category_coverage(pages).first()
    assert (counts.scanned, counts.mapped_pages, counts.mapped) == (5, 2, 1)


PARENTS = {
    "a": ["b", "x", "y"],
    "b": ["r", "a"],
    "x": ["y", "z"],
    "y": [],
    "z": ["r"],
    "hot": ["root"],
}
ARTICLES = [
    (1, ["a", "b"]),
    (2, []),
    (3, ["unknown"]),
    (4, ["z", "x", "a"]),
    (5, ["y"]),
    *[(100 + i, ["hot", "a"]) for i in range(200)],
]


@pytest.mark.parametrize("partitions", [1, 4, 64])
@pytest.mark.parametrize("salts", [1, 8])
def test_two_levels(spark, partitions, salts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        articles = spark.createDataFrame(ARTICLES, "page_id long, categories_direct array<string>")
        rows = hierarchy.resolve_hierarchy(articles, edges_of(spark, PARENTS), salts).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {r.page_id: tuple(list(v) for v in r[1:]) for r in rows}
    assert got == {page: expected(direct, PARENTS) for page, direct in ARTICLES}
    for direct, level1, level2, everything in got.values():
        assert everything == direct + level1 + level2


def classify(spark, title, direct, everything, rules):
    df = spark.createDataFrame(
        [(1, title, direct, everything)], "page_id long, title string, categories_direct array<string>, categories_all array<string>"
    )
    table = spark.createDataFrame(rules, RULES)
    r = taxonomy.classify_taxonomy(df, table).first()
    return r.taxonomy_l1, r.taxonomy_l2, r.taxonomy_l3


RULE_ROWS = [
    (2, "地理", "国・地域", "国"),
    (0, "人物", "政治家", "政治家"),
    (0, "人物", "政治家", "政治"),
    (1, "人物", "学者", "学者"),
]


@pytest.mark.parametrize(
    "title, direct, everything, want",
    [
        ("ある政治家", [], [], ("人物", "政治家", "政治家")),
        ("x", [], [], ("その他", "未分類", "未分類")),
        ("x", ["花"], ["花"], ("その他", "未分類", "花")),
        ("x", ["花", "日本の政治"], ["花", "日本の政治"], ("人物", "政治家", "日本の政治")),
        ("x", ["花"], ["花", "学者一覧"], ("人物", "学者", "学者一覧")),
        ("学者", ["花", "国"], ["花", "国"], ("人物", "学者", "花")),
        ("x", ["国の政治"], ["国の政治"], ("人物", "政治家", "国の政治")),
    ],
)
def test_taxonomy(spark, title, direct, everything, want):
    assert classify(spark, title, direct, everything, RULE_ROWS) == want


def test_no_rules_and_very_many(spark):
    assert classify(spark, "x", ["c"], ["c"], []) == ("その他", "未分類", "c")
    many = [(i // 10, f"l{i // 10}", "m", f"word {i};") for i in range(25_000)]
    assert classify(spark, "word 24999;", [], [], many) == ("l2499", "m", "m")
    assert classify(spark, "word 17; word 3;", [], [], many) == ("l0", "m", "m")


def test_no_hidden_limits():
    """Operators cut or collect only where that is the feature: top-N and bounded totals."""
    root = Path(taxonomy.__file__).parent.parent
    allowed = {"filters.py", "facets.py", "relevance.py"}  # limit_rows, keyset pages, top buckets, samples, newest
    for path in [*root.glob("operators/*.py"), *root.glob("sources/*.py"), *root.glob("plans/*.py")]:
        source = path.read_text()
        assert ".collect()" not in source, path.name
        assert ".limit(" not in source or path.name in allowed, path.name


def test_rules_from_file(spark, tmp_path):
    (tmp_path / "rules.json").write_text('{"rule_ord": 1, "l1": "A", "l2": "a", "keyword": "k"}\n')
    rules = taxonomy.read_rules(spark, str(tmp_path))
    assert rules.collect() == [(1, "A", "a", "k")]
    assert rules.filter(F.col("keyword") == "k").count() == 1


@pytest.mark.parametrize("seed", range(5))
def test_index_finds_the_rows_that_trying_all_keywords_finds(spark, seed):
    rng = random.Random(seed)
    word = lambda least: "".join(rng.choices("ab c", k=rng.randrange(least, 5)))
    rows = []
    for i in range(150):
        everything = [rng.choice([word(0), None] if rng.random() < 0.05 else [word(1)]) for _ in range(rng.randrange(0, 4))]
        direct = everything[: rng.randrange(0, 3)] + ([word(1)] if rng.random() < 0.1 else [])
        rows.append((i, None if rng.random() < 0.05 else word(0), direct, everything))
    df = spark.createDataFrame(rows, "page_id long, title string, categories_direct array<string>, categories_all array<string>")
    keywords = [(rng.randrange(6), rng.choice("xy"), rng.choice("mn"), rng.choice(["", None]) if rng.random() < 0.02 * seed else word(2) + rng.choice("abd")) for _ in range(12)]
    rules = spark.createDataFrame([*keywords, (9, "last", "l", "b")], RULES)
    want = taxonomy.classify_taxonomy(df, rules)
    got = taxonomy.classify_by_index(df, rules)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=lambda r: r.page_id) == sorted(want.collect(), key=lambda r: r.page_id)


def test_index_edges(spark):
    df = spark.createDataFrame([(1, "x", ["c"], ["c"]), (2, None, None, None)], "page_id long, title string, categories_direct array<string>, categories_all array<string>")
    for rules in ([], [(0, "a", "b", "")], [(0, "a", "b", None)], [(1, "a", "b", "zzz"), (1, "a", "b", "c")]):
        table = spark.createDataFrame(rules, RULES)
        pair = (taxonomy.classify_by_index(df, table), taxonomy.classify_taxonomy(df, table))
        assert [sorted(p.collect(), key=lambda r: r.page_id) for p in pair][0] == sorted(pair[1].collect(), key=lambda r: r.page_id)


def test_tables_with_a_row_per_page_are_not_broadcast(spark):
    """Stored page tables compress to a few megabytes, were taken for small and gathered in the driver."""
    from corpusloom.operators import taxonomy

    articles = spark.createDataFrame(
        [(1, "a src1", ["x"], ["x"])], "page_id long, title string, categories_direct array<string>, categories_all array<string>"
    )
    rules = spark.createDataFrame([(0, "A", "a1", "src1")], "rule_ord int, l1 string, l2 string, keyword string")
    found = taxonomy.classify_by_index(articles, rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "BroadcastHashJoin" not in plan
    assert [tuple(r)[-3:] for r in found.collect()] == [("A", "a1", "x")]


@pytest.mark.parametrize(("gram", "block"), [(16, 128), (3, 4)])
def test_only_substrings_that_are_keywords_are_moved(spark, monkeypatch, gram, block):
    """Every text used to be moved once per gram of three characters, and met all keywords with that gram."""
    monkeypatch.setattr(taxonomy, "GRAM", gram)
    monkeypatch.setattr(taxonomy, "BLOCK", block)
    rng = random.Random(gram)
    texts = ["".join(rng.choices("ab 東𠮷", k=rng.randrange(0, 30))) for _ in range(60)]
    keywords = sorted({t[i : i + n] for t in texts for i, n in [(rng.randrange(30), rng.randrange(1, 9))]} - {""}) + ["zzz", "a" * 40, texts[0] + "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    moved = []
    monkeypatch.setattr(taxonomy, "salted_join", lambda left, *a, **k: moved.append(left.count()) or salted_join(left, *a, **k))
    found = taxonomy.keyword_matches(df, spark.createDataFrame([(k,) for k in keywords], "keyword string"))
    want = sorted((i, k) for i, t in enumerate(texts) for k in keywords if k in t)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert len(moved) == 1 and (gram < 16 or moved[0] <= 2 * len(want))
