from __future__ import annotations

import bz2
import json
from concurrent.futures import ThreadPoolExecutor
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from corpusloom.schemas import ARTICLES
from corpusloom.session import claim_path
from corpusloom.sources import dump, ndjson, packing, publish, records

NOW = "2026-04-02 10:30:15"


def now():
    return F.lit(NOW).cast("timestamp")


def page(i: int, text: str, redirect: bool = False, revisions: int = 1) -> str:
    flag = '<redirect title="t" />' if redirect else ""
    revs = "".join(
        f'<revision><id>{7 * i}</id><contributor><id>5</id></contributor><text bytes="1" xml:space="preserve">'
        f"{escape(text if r == revisions - 1 else 'older')}</text></revision>"
        for r in range(revisions)
    )
    return f"  <page>\n    <title>T{i}</title>\n    <ns>{14 if i % 5 == 0 else 0}</ns>\n    <id>{i}</id>{flag}\n    {revs}\n  </page>\n"


def test_scan_many_streams_in_many_splits(spark, tmp_path):
    bodies = {i: f" line <b>&amp;</page> {i}\n" + "".join(chr(0x3041 + (i * k) % 80) for k in range(300)) + " " for i in range(1, 601)}
    head = '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/" version="0.11">\n  <siteinfo><sitename>s</sitename></siteinfo>\n'
    with open(tmp_path / "d.xml.bz2", "wb") as out:
        out.write(bz2.compress(head.encode()))
        for start in range(1, 601, 50):
            out.write(bz2.compress("".join(page(i, bodies[i], i % 7 == 0, 1 + i % 2) for i in range(start, start + 50)).encode()))
        out.write(bz2.compress(b"</mediawiki>\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = dump.scan_dump(spark, str(tmp_path / "d.xml.bz2"))
        assert df.rdd.getNumPartitions() >= 3
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.page_id: (r.title, r.ns, r.redirect, r.text) for r in rows}
    assert len(rows) == 600
    assert got == {i: (f"T{i}", 14 if i % 5 == 0 else 0, i % 7 == 0, t) for i, t in bodies.items()}


def test_scan_odd_pages(spark, tmp_path):
    (tmp_path / "d.xml").write_text(
        "<mediawiki><page><title/><ns>0</ns><id>1</id><revision><text /></revision></page>"
        "<page><title>b</title><id>2</id><redirect/><revision><text>plain</text></revision></page></mediawiki>"
    )
    rows = dump.scan_dump(spark, str(tmp_path / "d.xml")).orderBy("page_id").collect()
    assert rows == [(1, "", 0, False, ""), (2, "b", None, True, "plain")]


def test_broken_page_stops_the_job(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>a</ns></page></mediawiki>")
    with pytest.raises(Exception):
        dump.scan_dump(spark, str(tmp_path)).collect()
    assert dump.scan_dump(spark, str(tmp_path), strict=False).count() == 1


def test_custom_docs(spark, tmp_path):
    lines = [
        {"page_id": 71, "title": "t", "body": "b", "url": "https://notes.test/a"},
        {"page_id": 72, "title": "t", "body": "b", "fetched_at": "2026-01-01T00:00:00Z"},
        {"page_id": 73, "title": "t"},
    ]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    accepted, rejected = ndjson.read_custom_docs(spark, str(tmp_path), now())
    got = {r.page_id: (r.url, r.fetched_at.isoformat(" ")) for r in accepted.collect()}
    assert got == {71: ("https://notes.test/a", NOW), 72: ("", "2026-01-01 00:00:00")}
    assert rejected.count() == 2


def bulk(tmp_path, *lines: str):
    (tmp_path / "x.part0001.ndjson").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


GOOD = ('{"index": {"_id": "1"}}', '{"page_id": 1, "title": "a"}')


@pytest.mark.parametrize("framed", [False, True])
@pytest.mark.parametrize(
    "lines, problem",
    [
        ((*GOOD, '{"index": {"_id": "2"}}'), ndjson.NO_DOCUMENT),
        (('{"create": {"_id": "2"}}', '{"page_id": 2}'), ndjson.NOT_AN_ACTION),
        (('{"index": {}}', '{"page_id": 2}'), ndjson.NO_ID),
        ((*GOOD, '{"index": {"_id": "2"}}', '{"page_id": 2, "tit'), ndjson.BROKEN_DOCUMENT),
        ((*GOOD, '{"index": {"_id": "2"}}', '{"page_id": "two"}'), ndjson.BROKEN_DOCUMENT),
        ((*GOOD, '{"index": {"_id": "2"}}', '[1]'), ndjson.BROKEN_DOCUMENT),
    ],
)
def test_bad_bulk_files(spark, tmp_path, lines, problem, framed):
    path = bulk(tmp_path, *lines)
    docs, rejected = ndjson.read_bulk_ndjson(spark, path, strict=False, framed=framed)
    assert [r.problem for r in rejected.collect()] == [problem]
    assert docs.count() == (1 if lines[0] == GOOD[0] else 0)
    with pytest.raises(Exception, match="x.part0001.ndjson"):
        ndjson.read_bulk_ndjson(spark, path, framed=framed)[0].collect()


@pytest.mark.parametrize("framed", [False, True])
def test_bulk_numeric_id_and_extra_action_fields(spark, tmp_path, framed):
    path = bulk(tmp_path, '{"index": {"_index": "i", "_id": 7}}', '{"page_id": 7, "title": "{\\"index\\"", "body": "x\\ny"}')
    docs, _ = ndjson.read_bulk_ndjson(spark, path, framed=framed)
    assert [(r._id, r.title, r.body) for r in docs.collect()] == [("7", '{"index"', "x\ny")]


@pytest.mark.parametrize("framed", [False, True])
@pytest.mark.parametrize("split", ["200", "128m"])
def test_export_then_import_is_identity(spark, tmp_path, framed, split):
    rows = spark.range(200).selectExpr(
        "id * 3 as page_id", "concat('見出し \"', id, '\"') as title", "repeat(concat('本文\n', id), cast(id % 9 as int)) as body"
    )
    docs = records.rows_to_docs(records.apply_schema_contract(rows), now())
    sized = docs.withColumn("size", F.octet_length(ndjson.bulk_lines(docs)) + 1)
    ndjson.write_bulk_ndjson(packing.with_part_no(sized, "size", 4000, bucket_keys=150).drop("size"), str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("part_no=*/*.txt"))
    assert len(files) == len(list((tmp_path / "out").glob("part_no=*"))) > 10
    assert max(f.stat().st_size for f in files) <= 4000
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        back, rejected = ndjson.read_bulk_ndjson(spark, str(tmp_path / "out" / "*"), framed=framed)
        assert sorted(back.drop("_id").collect()) == sorted(docs.collect())
        assert rejected.count() == 0
        assert back.filter("_id <> cast(page_id as string)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    keys = [int(json.loads(x)["index"]["_id"]) for f in sorted(files) for x in f.read_text().splitlines()[::2]]
    assert keys == sorted(keys) and len(keys) == 200


def test_legal_files_of_other_writers(spark, tmp_path):
    path = bulk(tmp_path, '{ "index" : {"_id": "1"}}', '{"index": "first field", "page_id": 1}', '{"index":{"_id":"2"}}', '{"index":{"a":1},"page_id":2}')
    docs, rejected = ndjson.read_bulk_ndjson(spark, path)
    assert [(r._id, r.page_id) for r in docs.collect()] == [("1", 1), ("2", 2)] and rejected.count() == 0


def test_uncapped_export_keeps_its_files(spark, tmp_path):
    docs = records.rows_to_docs(records.apply_schema_contract(spark.range(0, 90, 1, 3).selectExpr("id as page_id", "'t' as title")), now())
    ndjson.write_bulk_ndjson(packing.with_part_no(docs.withColumn("n", F.lit(1)), "n", 0).drop("n"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part_no=*/*.txt"))) == 3
    assert ndjson.read_bulk_ndjson(spark, str(tmp_path / "out" / "*"))[0].count() == 90


def test_packing_needs_keys(spark):
    rows = spark.createDataFrame([(None, 1), (2, 3)], "page_id long, n int")
    with pytest.raises(Exception, match="no key"):
        packing.pack_by_bytes(rows, "n", 10).collect()
    large = spark.createDataFrame([(2**60 + i, 6) for i in range(4)] + [(-1, 6), (-300, 6)], "page_id long, n int")
    got = {r.page_id: (r.bucket, r.part) for r in packing.pack_by_bytes(large, "n", 12, bucket_keys=128).collect()}
    assert got == {**{2**60 + i: (2**53, i // 2) for i in range(4)}, -1: (-1, 0), -300: (-3, 0)}


def test_bulk_paths(spark, tmp_path):
    base = str(tmp_path / "x.ndjson")
    with pytest.raises(FileNotFoundError):
        ndjson.bulk_paths(spark, base)
    bulk(tmp_path, *GOOD)
    assert ndjson.read_bulk_ndjson(spark, ndjson.bulk_paths(spark, base))[0].count() == 1
    assert [p.rsplit("/", 1)[1] for p in ndjson.bulk_paths(spark, str(tmp_path / "x"))] == ["x.part0001.ndjson"]
    (tmp_path / "x.ndjson").write_text("\n".join(GOOD))
    assert [p.rsplit("/", 1)[1] for p in ndjson.bulk_paths(spark, base)] == ["x.ndjson"]


@pytest.mark.parametrize("cap", [0, -1, 1, 50, 100, 10**9])
def test_packing_against_the_rule(spark, cap):
    sizes = [(i * 7919 % 61) + 1 for i in range(500)]
    sizes[100], sizes[0] = 5000, 300
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "page_id long, n int")
    got = {r.page_id: (r.bucket, r.part) for r in packing.pack_by_bytes(rows, "n", cap, bucket_keys=128).collect()}
    want = {}
    for bucket in range(4):
        part, used, filled = 0, 0, 0
        for i in range(bucket * 128, min(500, bucket * 128 + 128)):
            if filled and used + sizes[i] > cap:
                part, used, filled = part + 1, 0, 0
            used, filled = used + sizes[i], filled + 1
            want[i] = (bucket, part)
    assert got == (want if cap > 0 else {i: (None, None) for i in range(500)})


def test_upsert_hot_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "page_id long, title string")
    delta = spark.createDataFrame([(2, f"v{i}", i) for i in range(300)] + [(3, "n", 0)], "page_id long, title string, seq int")
    rows = records.upsert(base, delta, ["page_id"], "seq").orderBy("page_id").collect()
    assert rows == [(1, "a"), (2, "v299"), (3, "n")]
    assert records.upsert(base, delta, ["page_id"], "seq").count() == 3


def test_rows_to_docs(spark):
    rows = spark.createDataFrame(
        [(1, "t", None, None, None, '["a","b"]', "", None, "[]", None, "x", None)],
        "page_id long, title string, body string, url string, fetched_at string, categories_direct string, categories_level1 string,"
        "categories_level2 string, categories_all string, taxonomy_l1 string, taxonomy_l2 string, taxonomy_l3 string",
    )
    assert records.rows_to_docs(rows, now()).first() == (1, "t", "", "", "2026-04-02T10:30:15Z", ["a", "b"], [], [], [], "", "x", "")


def test_broken_lists_are_not_empty_lists(spark):
    rows = records.apply_schema_contract(spark.range(1).selectExpr("id as page_id")).withColumn("categories_all", F.lit("[1"))
    with pytest.raises(Exception, match="categories_all of page 0"):
        records.rows_to_docs(rows, now()).collect()
    assert records.rows_to_docs(rows, now(), strict=False).first().categories_all == []


def test_own_documents_stay_unique(spark):
    base = spark.createDataFrame([(1, "a")], "page_id long, title string")
    own = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1), (2, "d", 1)], "page_id long, title string, seq int")
    assert sorted(records.union_custom(base, own, "seq").collect()) == [(1, "c"), (2, "d")]


def test_names_that_share_a_prefix(spark, tmp_path):
    root = str(tmp_path)
    assert publish.publish_snapshot(spark.range(1), root, "a", "s-20260402", "1")[0] == "s-20260402-1"
    assert publish.publish_snapshot(spark.range(1), root, "a", "s", "20260402")[0] == "s-20260402"
    assert publish.publish_snapshot(spark.range(1), root, "a", "s", "20260402")[0] == "s-20260402-2"


def test_publishers_at_the_same_time(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda i: publish.publish_snapshot(spark.range(i + 1), root, "a/b", "s", "20260402"), range(8)))
    assert sorted(n for n, _ in done) == sorted(["s-20260402", *(f"s-20260402-{i}" for i in range(1, 8))])
    assert len(publish._switches(spark, root, "a/b")) == 8
    name = publish.current_snapshot(spark, root, "a/b")
    assert publish.read_alias(spark, root, "a/b").count() == dict(done)[name]
    with ThreadPoolExecutor(8) as pool:
        names = list(pool.map(lambda _: publish.claim_name(spark, root, "t", "1"), range(24)))
    assert len(set(names)) == 24
    assert not claim_path(spark, f"{root}/_names/{names[0]}", "again")
    claim_path(spark, f"{root}/_aliases/a%2Fb/{10**6:012d}", "")  # lost before it wrote
    assert publish.current_snapshot(spark, root, "a/b") == name


@pytest.mark.parametrize("cap", [0, 700])
def test_requests_are_packed_by_bucket(spark, cap):
    rows = spark.range(0, 1000, numPartitions=4).select(F.col("id").alias("page_id"), (F.col("id") % 37 + 1).alias("bytes"))
    filed = packing.with_part_no(rows, "bytes", cap=cap, bucket_keys=100)
    got = sorted(packing.pack_requests(filed, "bytes", cap=90, bucket_keys=100).collect(), key=lambda r: r.page_id)
    assert len(got) == 1000 and {r.bucket for r in got} == set(range(10))
    at = None
    for r in got:
        if (r.part_no, r.bucket) != at:
            at, request, used = (r.part_no, r.bucket), 0, 0
        if used and used + r.bytes > 90:
            request, used = request + 1, 0
        used += r.bytes
        assert r.request == request


def test_encode_keeps_unicode(spark):
    df = spark.createDataFrame([(["東京", 'a"b'],)], "c array<string>")
    assert records.encode_list_columns(df, ["c"]).first().c == '["東京","a\\"b"]'


def test_contract(spark):
    df = spark.createDataFrame([("12", "x", 5), ("no", None, 6)], "page_id string, categories_all string, extra int")
    out = records.apply_schema_contract(df)
    assert out.schema == ARTICLES or [f.name for f in out.schema] == ARTICLES.names
    assert [r.page_id for r in out.collect()] == [12, None]
    lost = {r.field: r.violations for r in records.contract_violations(df).collect()}
    assert lost["page_id"] == 1 and lost["categories_all"] == 1 and lost["title"] == 0 and len(lost) == 12


def test_publish(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5).withColumnRenamed("id", "page_id")
    assert publish.current_snapshot(spark, root, "a") is None
    with pytest.raises(RuntimeError):
        publish.read_alias(spark, root, "a")
    assert publish.publish_snapshot(df, root, "a", "s", "20260402") == ("s-20260402", 5)
    assert publish.publish_snapshot(df.limit(2), root, "a", "s", "20260402", ["page_id"]) == ("s-20260402-1", 2)
    assert publish.publish_snapshot(df.filter("page_id < 0"), root, "a", "s", "20260402") == ("s-20260402-2", 0)
    assert publish.current_snapshot(spark, root, "a") == "s-20260402-1"
    assert publish.read_alias(spark, root, "a", view=True).count() == 2
    assert spark.sql("SELECT count(*) AS n FROM a").first().n == 2
    assert spark.read.parquet(f"{root}/s-20260402").count() == 5
    assert publish.publish_snapshot(df, root, "b", "s", "20260403") == ("s-20260403", 5)
    assert publish.current_snapshot(spark, root, "a") == "s-20260402-1"


def test_failed_load_leaves_the_alias(spark, tmp_path):
    root = str(tmp_path)
    publish.publish_snapshot(spark.range(3), root, "a", "s", "20260402")
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception):
        publish.publish_snapshot(bad, root, "a", "s", "20260402")
    assert publish.current_snapshot(spark, root, "a") == "s-20260402"
    assert publish.publish_snapshot(spark.range(1), root, "a", "s", "20260402")[0] == "s-20260402-2"
