from __future__ import annotations

import json
import os
import random

from pyspark.sql import functions as F

from corpusloom.streaming import ingest, sessions, versions


def test_incremental_and_repeatable(spark, tmp_path):
    source, deltas, checkpoint = (str(tmp_path / n) for n in ("in", "deltas", "cp"))
    (tmp_path / "in").mkdir()
    now = F.lit("2026-04-02 10:30:15").cast("timestamp")

    def drop(name: str, *docs: dict) -> None:
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, docs)) + "\n")

    def run() -> None:
        ingest.stream_custom_docs(spark, source, deltas, checkpoint, 1, now).awaitTermination()

    drop("a.json", {"page_id": 1, "title": "t1", "body": "b"}, {"page_id": 2, "title": "t2"})
    run()
    drop("b.json", {"page_id": 1, "title": "t1 again", "body": "b"}, {"page_id": 7, "title": "t7", "body": "b"})
    run()
    run()
    assert {r.page_id: r.title for r in ingest.read_deltas(spark, deltas).collect()} == {1: "t1 again", 7: "t7"}
    base = spark.createDataFrame([(1, "old", "x"), (5, "kept", "y")], "page_id long, title string, taxonomy_l1 string")
    merged = {r.page_id: (r.title, r.taxonomy_l1) for r in ingest.merge_deltas(base, deltas).collect()}
    assert merged == {1: ("t1 again", None), 5: ("kept", "y"), 7: ("t7", None)}


def test_order_rejects_and_empty_start(spark, tmp_path):
    source, deltas, checkpoint = (str(tmp_path / n) for n in ("in", "deltas", "cp"))
    (tmp_path / "in").mkdir()
    base = spark.createDataFrame([(1, "old", "x")], "page_id long, title string, taxonomy_l1 string")
    assert ingest.merge_deltas(base, deltas).collect() == base.collect() and ingest.read_deltas(spark, deltas).count() == 0
    lines = [json.dumps({"page_id": 1, "title": f"v{i}", "body": "b"}) for i in range(40)]
    (tmp_path / "in" / "a.json").write_text("\n".join([*lines, "{broken", '{"page_id": 3}']) + "\n")
    now = F.lit("2026-04-02 10:30:15").cast("timestamp")
    ingest.stream_custom_docs(spark, source, deltas, checkpoint, 10, now).awaitTermination()
    assert [r.title for r in ingest.read_deltas(spark, deltas).collect()] == ["v39"]
    assert spark.read.parquet(f"{deltas}-rejected").count() == 2
    ingest.compact_deltas(spark, deltas, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 1
    assert {r.title for r in ingest.merge_deltas(base, str(tmp_path / "compact")).collect()} == {"v39"}


def events_in_files(tmp_path, files):
    """JSON files with successive times of change."""
    (tmp_path / "in").mkdir()
    for n, rows in enumerate(files):
        path = tmp_path / "in" / f"{n}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(tmp_path / "in")


def at(minute, **more):
    return {"ts": f"2026-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000Z", **more}


def test_versions(spark, tmp_path):
    source = events_in_files(
        tmp_path,
        [
            [at(10, k="a", n=1), at(12, k="a", n=2), at(30, k="b", n=3), {"k": None, "n": 9, "ts": None}],
            [at(12, k="a", n=2), at(11, k="a", n=4), at(5, k="c", n=5), at(30, k="b", n=6)],  # watermark at 10
            [at(60, k="a", n=7), at(20, k="d", n=8)],
            [at(39, k="a", n=10), at(40, k="d", n=11), at(41, k="b", n=12)],  # watermark at 40
        ],
    )
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "k string, ts timestamp, n long"
    run = lambda: versions.stream_versions(spark, source, schema, target, checkpoint, "k", "ts", "n", "20 minutes", 1).awaitTermination()
    assert versions.read_versions(spark, target) is None
    run()
    run()  # nothing new
    rows = versions.read_versions(spark, target).collect()
    assert sorted((r.batch_id, r.n, r.fate) for r in rows if r.batch_id < 4) == [
        (0, 1, "overtaken"), (0, 2, "newest"), (0, 3, "newest"),
        (1, 2, "repeated"), (1, 4, "overtaken"), (1, 5, "late"), (1, 6, "newest"),
        (2, 7, "newest"), (2, 8, "newest"),
        (3, 10, "late"), (3, 11, "newest"), (3, 12, "newest"),
    ]
    newest = versions.newest_versions(versions.read_versions(spark, target), "k")
    assert newest.columns == ["k", "ts", "n"]
    assert {r.k: r.n for r in newest.collect()} == {"a": 7, "b": 12, "d": 11}


def test_sessions_of_table_and_stream(spark, tmp_path):
    rng = random.Random(3)
    minutes = sorted(rng.randrange(0, 1400) for _ in range(300))
    rows = [at(m, u=rng.randrange(4), v=i) for i, m in enumerate(minutes)]
    want = {}
    for u in range(4):
        run = []
        for r, m in zip(rows, minutes, strict=True):
            if r["u"] == u:
                if run and m > run[-1][0] + 15:
                    want[u, run[0][0]] = (run[-1][0] + 15, len(run), sum(v for _, v in run))
                    run = []
                run.append((m, r["v"]))
        want[u, run[0][0]] = (run[-1][0] + 15, len(run), sum(v for _, v in run))
    source = events_in_files(tmp_path, [rows[i : i + 75] for i in range(0, 300, 75)])
    schema, measures = "ts timestamp, u int, v long", {"total": F.sum("v")}
    minute = lambda t: t.hour * 60 + t.minute + (1440 if t.day == 2 else 0)
    shown = lambda df: {(r.u, minute(r.session_start)): (minute(r.session_end), r.events, r.total) for r in df.collect()}
    assert shown(sessions.sessions(spark.read.schema(schema).json(source), ["u"], "ts", "15 minutes", measures)) == want
    target = str(tmp_path / "out")
    sessions.stream_sessions(spark, source, schema, target, str(tmp_path / "cp"), ["u"], "ts", "15 minutes", "30 minutes", measures, 1).awaitTermination()
    closed = {k: v for k, v in want.items() if v[0] <= minutes[-1] - 30}
    assert shown(spark.read.parquet(target)) == closed and len(closed) < len(want)
