from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from corpusloom.schemas import RECORDS
from corpusloom.sources import records, templates


def test_all_record_schemas_parse(spark):
    assert all(isinstance(T.StructType.fromDDL(ddl), T.StructType) for ddl in RECORDS.values()) and len(RECORDS) == 8


def test_evaluation_record(spark, tmp_path):
    doc = {
        "_id": "e1",
        "benchmark_id": "b",
        "summary": {"ndcg": 0.5},
        "task": {"k": 10, "scenarios": {"tags": ["t"], "sample_size": 5}},
        "results": [{"strategy_id": "s", "searches": [{"scenario_id": "q", "hits": [{"hit": {"_id": "1", "_score": 2.5}, "rating": 3}]}]}],
        "took": 7,
        "later": {"x": 1},
    }
    (tmp_path / "e.json").write_text(json.dumps(doc) + "\n\n{broken\n")
    found, unreadable = records.read_records(spark, str(tmp_path), "evaluations")
    row = found.first()
    assert (row._id, row.took, json.loads(row.summary)) == ("e1", 7, {"ndcg": 0.5})
    assert row.results[0].searches[0].hits[0].rating == 3
    assert row.extra == {"later": '{"x":1}'}
    assert found.count() == 1 and [r.value for r in unreadable.collect()] == ["{broken"]


TEMPLATE = {
    "index_patterns": ["notes-*"],
    "priority": 40,
    "template": {
        "mappings": {
            "properties": {
                "note_id": {"type": "integer"},
                "title": {"type": "text"},
                "tags": {"type": "keyword"},
                "at": {"type": "date"},
                "scale": {"properties": {"min": {"type": "byte"}}},
                "steps": {"type": "nested", "properties": {"data": {"type": "object", "enabled": False}}},
            }
        }
    },
}


def test_template_schema_and_choice(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps(TEMPLATE, indent=2))
    template = templates.read_template(spark, str(tmp_path / "t.json"))
    schema = templates.template_schema(template, {"tags"})
    assert schema.simpleString() == (
        "struct<note_id:bigint,title:string,tags:array<string>,at:timestamp,scale:struct<min:tinyint>,steps:array<struct<data:string>>>"
    )
    low = {"index_patterns": ["*"], "priority": 1}
    assert templates.template_for("notes-1", [low, TEMPLATE]) is TEMPLATE
    assert templates.template_for("other", [low, TEMPLATE]) is low
    assert templates.template_for("other", [TEMPLATE]) is None
    df = spark.createDataFrame([("5", "t")], "note_id string, title string")
    assert records.apply_schema_contract(df, schema).first().note_id == 5
    with pytest.raises(ValueError):
        templates.parse_template("[1]")
