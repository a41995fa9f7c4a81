from __future__ import annotations

import hashlib
import re

from llm_fixtures import SF, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import decontamination
from corpusloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[at : at + n]), set()).add("" if item is None else str(item))
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if mine := windows.get(tuple(w[at : at + n])):
                    hit |= set(range(at, at + n))
                    found |= mine
        out.append((len(w), len(hit), sorted(found)))
    return out


def check(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(decontamination.decontaminate(docs, bench).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_hit, r.item_ids) for r in got] == brute(texts, items)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my"


def test_windows_short_items_and_cases(spark):
    check(
        spark,
        [
            f"before {ITEM} after", f"before {ITEM.upper()}! after", " ".join(ITEM.split()[1:11]), " ".join(ITEM.split()[:9]), None, "",
            "two words and one two words", f"{ITEM} {ITEM}", "ÉTÉ alpha", "été alpha", " ".join(["a"] * 40), "in a word",
        ],
        [(1, ITEM), (2, "two words"), (3, "été"), (4, None), (5, ""), (None, "word"), (1, "again"), (6, " ".join(["a"] * 12))],
    )


def test_random_texts(spark):
    import random

    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "b", "Ab", "é"]) for _ in range(n))
    check(spark, [text(rng.randrange(0, 120)) for _ in range(40)], [(i, text(rng.choice([3, 9, 10, 11, 30]))) for i in range(8)])


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "A few words of its own, and an end of it.")], "item_id long, text string")
    rows = decontamination.decontaminate(edge_docs, bench).collect()
    assert len(rows) == edge_docs.count() and {r.kept for r in rows} == {"mine"}
    assert decontamination.decontaminate(no_docs, bench).collect() == []
    none = decontamination.decontaminate(edge_docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op9_decontamination"](spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for (id_, _), (n, hit, found) in zip(docs, brute([t for _, t in docs], items), strict=True):
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert tuple(got[id_])[1:] == (n, hit, len(found), digest, hit > 0)


def test_native(spark):
    plan = QUERIES["op9_decontamination"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
