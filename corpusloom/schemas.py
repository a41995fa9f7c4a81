"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_strings = T.ArrayType(T.StringType())

#: One page element. A page has its own id first and may carry several revisions.
DUMP_PAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("ns", T.StringType()),
        T.StructField("id", _strings),
        T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
        T.StructField(
            "revision",
            T.ArrayType(
                T.StructType([T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))])
            ),
        ),
    ]
)

#: The published article table; also the contract of anything loaded into it.
ARTICLES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("categories_direct", _strings),
        T.StructField("categories_level1", _strings),
        T.StructField("categories_level2", _strings),
        T.StructField("categories_all", _strings),
        T.StructField("taxonomy_l1", T.StringType()),
        T.StructField("taxonomy_l2", T.StringType()),
        T.StructField("taxonomy_l3", T.StringType()),
    ]
)

#: The same twelve fields as exported documents: the date is text.
DOCUMENTS = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "fetched_at" else f.dataType) for f in ARTICLES]
)

CUSTOM_DOC = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)
CUSTOM_REQUIRED = ("page_id", "title", "body")

BULK_ACTION = T.StructType([T.StructField("index", T.StructType([T.StructField("_id", T.StringType())]))])

TAXONOMY_RULE = T.StructType(
    [
        T.StructField("rule_ord", T.IntegerType()),
        T.StructField("l1", T.StringType()),
        T.StructField("l2", T.StringType()),
        T.StructField("keyword", T.StringType()),
    ]
)

_META = (
    "`@meta` struct<created_at:timestamp,created_by:string,created_via:string,"
    "updated_at:timestamp,updated_by:string,updated_via:string>"
)
_TASK = (
    "task struct<metrics:array<string>,k:smallint,requests:int,"
    "strategies:struct<_ids:array<string>,tags:array<string>,docs:string>,"
    "scenarios:struct<_ids:array<string>,tags:array<string>,sample_size:int,sample_seed:string>>"
)

# Field names of the records of relevance evaluation.
#: Opaque objects are kept as JSON text; fields of a record
#: that are not listed go to a map, see ``read_records``.
RECORDS = {
    "workspaces": f"_id string, {_META}, name string, index_pattern string, params array<string>,"
    " rating_scale struct<min:tinyint,max:tinyint>, tags array<string>, description string",
    "displays": f"_id string, {_META}, workspace_id string, index_pattern string, fields array<string>,"
    " template struct<body:string,image:struct<position:string,url:string>>",
    "scenarios": f"_id string, {_META}, workspace_id string, name string, params array<string>, tags array<string>,"
    " values map<string,string>",
    "strategies": f"_id string, {_META}, workspace_id string, name string, params array<string>, tags array<string>,"
    " template struct<lang:string,source:string>",
    "judgements": f"_id string, {_META}, workspace_id string, scenario_id string, index string, doc_id string,"
    " rating tinyint",
    "benchmarks": f"_id string, {_META}, workspace_id string, name string, description string, tags array<string>, {_TASK}",
    "evaluations": "_id string, `@meta` struct<status:string,created_at:timestamp,created_by:string,created_via:string,"
    "started_at:timestamp,started_by:string,stopped_at:timestamp>, workspace_id string, benchmark_id string,"
    f" scenario_id array<string>, strategy_id array<string>, summary string, {_TASK},"
    " results array<struct<strategy_id:string,searches:array<struct<scenario_id:string,"
    "metrics:struct<dcg:double,err:double,mrr:double,ndcg:double,precision:double,recall:double>,"
    "hits:array<struct<hit:struct<_id:string,_index:string,_score:double>,rating:tinyint>>>>,failures:string>>,"
    " runtime struct<indices:string,scenarios:string,strategies:string,judgements:string>,"
    " unrated_docs array<struct<_id:string,_index:string,count:int,strategies:array<string>,scenarios:array<string>>>,"
    " error struct<type:string,message:string,traceback:string>, took int",
    "conversations": f"_id string, {_META}, title string, conversation_id string,"
    " rounds array<struct<id:string,status:string,input:struct<message:string>,"
    "steps:array<struct<type:string,reasoning:string,tool_id:string,params:string,tool_call_id:string,"
    "results:array<struct<type:string,data:string>>>>,started_at:timestamp,time_to_first_token:int,"
    "time_to_last_token:int,model_usage:struct<inference_id:string,llm_calls:int,input_tokens:int,output_tokens:int>,"
    "response:struct<message:string>>>",
}
