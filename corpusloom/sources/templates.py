"""Table contracts from document templates.

A template is a small JSON object with name patterns, a priority and field types. It is read
on the driver as configuration; what it yields is a schema for ``apply_schema_contract``.
"""

from __future__ import annotations

import json
from fnmatch import fnmatchcase

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Field types of a template and the column types they become.
FIELD_TYPES = {
    "keyword": T.StringType(),
    "text": T.StringType(),
    "integer": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "float": T.DoubleType(),
    "date": T.TimestampType(),
    "object": T.StringType(),
}


def parse_template(text: str) -> dict:
    """A template from JSON text; anything but an object is refused."""
    template = json.loads(text)
    if not isinstance(template, dict):
        raise ValueError("a template must be a JSON object")
    return template


def read_template(spark: SparkSession, path: str) -> dict:
    """A template file of any file system Spark reaches."""
    return parse_template(spark.read.text(path, wholetext=True).first()["value"])


def template_for(name: str, templates: list[dict]) -> dict | None:
    """The template of highest priority with a pattern that matches the table name."""
    matching = [t for t in templates if any(fnmatchcase(name, p) for p in t.get("index_patterns", []))]
    return max(matching, key=lambda t: t.get("priority", 0), default=None)


def template_schema(template: dict, lists: set[str] = frozenset()) -> T.StructType:
    """The columns of a template; ``lists`` names the fields that hold several values.

    A template does not tell single values from lists, so that is said by the caller.
    """
    return _struct(template["template"]["mappings"]["properties"], lists)


def _struct(properties: dict, lists: set[str]) -> T.StructType:
    return T.StructType([T.StructField(name, _field(name, spec, lists)) for name, spec in properties.items()])


def _field(name: str, spec: dict, lists: set[str]) -> T.DataType:
    if "properties" in spec:
        kind = _struct(spec["properties"], lists)
        return T.ArrayType(kind) if spec.get("type") == "nested" or name in lists else kind
    kind = FIELD_TYPES[spec["type"]]
    return T.ArrayType(kind) if name in lists else kind
