"""Custom documents and bulk files: JSON lines in, JSON lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.schemas import BULK_ACTION, CUSTOM_DOC, CUSTOM_REQUIRED, DOCUMENTS
from corpusloom.session import matching_paths

# Fixed value: how the action lines begin that this module writes. Then why a pair is refused.
ACTION_START = '{"index"'
NO_DOCUMENT = "the file ends after an action; a document line should follow"
NOT_AN_ACTION = "an action line should be a JSON object with the key index"
NO_ID = "the action names no document id"
EXTRA_LINE = "an action should be followed by one document line, not by several"
BROKEN_DOCUMENT = "the document line is no JSON object of the document fields"
_CORRUPT = T.StructField("_corrupt", T.StringType())


def read_custom_docs(spark: SparkSession, path: str, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Own documents as JSON lines: ``(accepted, rejected)``.

    Broken lines and lines lacking a required field are rejected; a missing url becomes the
    empty string, a missing date ``now``.
    """
    raw = (
        spark.read.schema(CUSTOM_DOC)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
    )
    return split_custom_docs(raw, now)


def split_custom_docs(raw: DataFrame, now: Column | None = None, carry: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of parsed custom documents; ``carry`` names further columns to keep."""
    complete = F.col("_corrupt").isNull()
    for name in CUSTOM_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    accepted = raw.filter(complete).select(
        "page_id",
        "title",
        "body",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("fetched_at", now if now is not None else F.current_timestamp()).alias("fetched_at"),
        *carry,
    )
    return accepted, raw.filter(~complete)


def _checked(pairs: DataFrame) -> DataFrame:
    """Pairs of ``(file, line, action, doc, problem)`` with ``_id``, the parsed ``d``, and what is wrong, if anything."""
    action = F.from_json("action", BULK_ACTION)
    # A generic map shows whether the key is there at all.
    keys = F.map_keys(F.from_json("action", "map<string,string>"))
    # In this mode a line that is no object, or whose fields have other types, parses to null.
    parsed = F.from_json("doc", T.StructType([*DOCUMENTS, _CORRUPT]), {"columnNameOfCorruptRecord": _CORRUPT.name})
    work = pairs.withColumns({"_id": action["index"]["_id"], "d": parsed})
    problem = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(~F.coalesce(F.array_contains(keys, "index"), F.lit(False)), F.lit(NOT_AN_ACTION))
        .when(F.coalesce("_id", F.lit("")) == "", F.lit(NO_ID))
        .when(F.col("doc").isNull(), F.lit(NO_DOCUMENT))
        .when(F.col("d").isNull() | F.col(f"d.{_CORRUPT.name}").isNotNull() | ~F.rlike("doc", F.lit(r"^\s*\{")), F.lit(BROKEN_DOCUMENT))
    )
    return work.withColumn("problem", problem)


def _framed_pairs(spark: SparkSession, paths) -> DataFrame:
    """Pairs cut where a line begins with an index action: no shuffle, any split size."""
    pieces = spark.read.option("lineSep", "\n" + ACTION_START).text(paths).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    record = F.when(F.startswith("value", F.lit("{")), F.col("value")).otherwise(F.concat(F.lit(ACTION_START), "value"))
    lines = F.split(F.rtrim(record, F.lit("\n")), "\n")
    return pieces.filter(F.trim("value") != "").select(
        "file",
        F.lit(None).cast("long").alias("line"),
        lines[0].alias("action"),
        F.get(lines, 1).alias("doc"),
        F.when(F.size(lines) > 2, F.lit(EXTRA_LINE)).alias("problem"),
    )


def _numbered_pairs(spark: SparkSession, paths) -> DataFrame:
    """Pairs by line number, whatever the action line looks like.

    Lines are numbered inside a file block, whose size is bounded, and shifted by the number
    of lines in the blocks before it; an even line and the next one make a pair.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shift = (
        lines.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select("file", "block", F.coalesce(before, F.lit(0)).alias("shift"))
    )
    in_block = F.row_number().over(Window.partitionBy("file", "block").orderBy("id")) - 1
    numbered = lines.withColumn("line", in_block).join(shift, ["file", "block"])
    line = F.col("line") + F.col("shift")
    return (
        numbered.groupBy("file", F.floor(line / 2).alias("pair"))
        .agg(
            F.max(F.when(line % 2 == 0, F.col("value"))).alias("action"),
            F.max(F.when(line % 2 == 1, F.col("value"))).alias("doc"),
        )
        .select("file", (2 * F.col("pair") + 1).alias("line"), "action", "doc", F.lit(None).cast("string").alias("problem"))
    )


def bulk_paths(spark: SparkSession, path: str) -> list[str]:
    """The files that an export named ``path`` left, by listing the file system.

    That is a file or folder of the name; else, for ``name.ext``, its numbered files
    ``name.partN.ext``, and for a bare ``name`` those with the ending ndjson.
    """
    stem, _, ending = path.rpartition(".") if "." in path.rsplit("/", 1)[-1] else (path, ".", "ndjson")
    found = matching_paths(spark, path) or matching_paths(spark, f"{stem}.part[0-9]*.{ending}")
    if not found:
        raise FileNotFoundError(f"no bulk export at {path}, neither as one file or folder nor as numbered files")
    return found


def read_bulk_ndjson(
    spark: SparkSession, paths, strict: bool = True, framed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Bulk files as ``(documents, rejected)``; documents are ``(_id, twelve fields)``.

    Only the id is taken from the action. Lines are paired by number, whatever they look like.
    ``framed`` cuts files as this module writes them where an action line begins, without a
    shuffle; other files may lose their framing so. A pair with a broken action or document is
    rejected, never read as an empty document; strict mode stops the job at the first one, as a
    bulk load must not go on without it.
    """
    pairs = _checked((_framed_pairs if framed else _numbered_pairs)(spark, paths))
    rejected = pairs.filter(F.col("problem").isNotNull()).select("file", "line", "action", "doc", "problem")
    if strict:
        where = F.concat(F.col("file"), F.coalesce(F.concat(F.lit(", line "), F.col("line")), F.lit("")))
        stop = F.raise_error(F.concat(where, F.lit(": "), F.col("problem")))
        pairs = pairs.withColumn("d", F.when(F.col("problem").isNotNull(), stop).otherwise(F.col("d")))
    else:
        pairs = pairs.filter(F.col("problem").isNull())
    return pairs.select("_id", *(F.col(f"d.{f.name}").alias(f.name) for f in DOCUMENTS)), rejected


def bulk_lines(docs: DataFrame, key: str = "page_id") -> Column:
    """The action line and the document line of one row, joined by a line end."""
    action = F.to_json(F.struct(F.struct(F.col(key).cast("string").alias("_id")).alias("index")))
    document = F.to_json(F.struct(*[c for c in docs.columns if c != "part_no"]), {"ignoreNullFields": "false"})
    return F.concat(action, F.lit("\n"), document)


def write_bulk_ndjson(docs: DataFrame, path: str, key: str = "page_id") -> None:
    """Write rows that carry ``part_no`` as one text file per part, in key order.

    Rows of a part meet in one task, which its cap bounds. A null ``part_no`` means that the
    row belongs to no capped part: such rows stay in as many files as there are tasks.
    """
    lines = docs.select("part_no", key, bulk_lines(docs, key).alias("value"))
    capped = lines.filter(F.col("part_no").isNotNull()).repartition("part_no").sortWithinPartitions("part_no", key)
    free = lines.filter(F.col("part_no").isNull())
    capped.drop(key).write.partitionBy("part_no").text(path)
    free.select("value").write.mode("append").text(f"{path}/part_no=uncapped")
