"""Keyed tables: latest version per key, upsert, delete, stamps, contracts and row/document forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.schemas import ARTICLES, RECORDS

# Fixed value: how a date is written in a document.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def latest_by_key(df: DataFrame, key: list[str], seq: str | list[str]) -> DataFrame:
    """The row of greatest ``seq``, one column or several, per key.

    Ranking keeps one row per key before the shuffle already, so a key with very many versions
    is not a hot key.
    """
    order = [seq] if isinstance(seq, str) else seq
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*map(F.desc, order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def upsert(base: DataFrame, delta: DataFrame, key: list[str], seq: str) -> DataFrame:
    """``base``, unique by key, with the rows of ``delta`` inserted or overwriting all columns.

    Within the delta the greatest ``seq`` wins. The base is not regrouped: its replaced rows
    are dropped by an anti join on the delta's keys, which Spark broadcasts when their measured
    size allows.
    """
    last = latest_by_key(delta, key, seq).drop(seq)
    kept = base.join(delta.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(last.select(*base.columns))


def union_custom(base: DataFrame, custom: DataFrame, seq: str | list[str], key: str = "page_id") -> DataFrame:
    """Own documents appended to the published corpus; the same key overwrites, the greatest ``seq`` last.

    Columns a custom document lacks stay missing.
    """
    order = [seq] if isinstance(seq, str) else seq
    last = latest_by_key(custom, [key], order).drop(*order)
    kept = base.join(custom.select(key).distinct(), key, "left_anti")
    return kept.unionByName(last, allowMissingColumns=True).select(*base.columns)


def delete_by_key(base: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """``base`` without the given keys."""
    return base.join(keys.select(*key).distinct(), key, "left_anti")


def stamp_upsert(base: DataFrame, delta: DataFrame, key: list[str], seq: str, user: str, via: str) -> DataFrame:
    """Upsert of records that carry ``created_*`` and ``updated_*`` stamps.

    A new record is created at the time of its version, ``seq``, by ``user`` via ``via``. An
    existing one keeps its created stamps and has the updated stamps overwritten.
    """
    stamps = ["created_at", "created_by", "created_via", "updated_at", "updated_by", "updated_via"]
    last = latest_by_key(delta, key, seq)
    both = base.select(F.struct(*base.columns).alias("old"), *key).join(
        last.select(F.struct(*last.columns).alias("new"), *key), key, "full"
    )
    known, changed = F.col("old").isNotNull(), F.col("new").isNotNull()
    new = {"at": F.col(f"new.{seq}"), "by": F.lit(user), "via": F.lit(via)}

    def merged(name: str) -> Column:
        event, _, k = name.partition("_")
        if name not in stamps:
            value = F.col(f"new.{name}") if name in last.columns else F.lit(None)
            return F.when(changed, value).otherwise(F.col(f"old.{name}"))
        if event == "created":
            return F.when(known, F.col(f"old.{name}")).otherwise(new[k])
        return F.when(~changed, F.col(f"old.{name}")).when(known, new[k])

    return both.select(*(merged(c).alias(c) for c in base.columns))


def encode_list_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """List columns as JSON text, for stores without arrays; nothing is ASCII-escaped."""
    return df.withColumns({c: F.to_json(c) for c in columns})


def rows_to_docs(rows: DataFrame, now: Column, strict: bool = True) -> DataFrame:
    """Table rows as documents: nothing null, lists decoded, the date as ISO text.

    List columns may be arrays or JSON text; text that is no JSON list stops the job, or, not
    ``strict``, becomes the empty list. ``now``, one value per job, replaces a missing or
    unreadable date.
    """
    types = dict(rows.dtypes)
    def listed(name: str) -> Column:
        value = F.col(name)
        if types[name] == "string":
            text = F.nullif(value, F.lit(""))
            value = F.from_json(text, "array<string>")
            if strict:
                stop = F.raise_error(F.concat(F.lit(f"{name} of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?")), F.lit(" is no JSON list")))
                value = F.when(text.isNotNull() & value.isNull(), stop).otherwise(value)
        return F.coalesce(value, F.array().cast("array<string>")).alias(name)

    date = F.coalesce(F.expr("try_cast(fetched_at as timestamp)"), now)
    return rows.select(
        "page_id",
        "title",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("body", "url")],
        F.date_format(date, ISO_SECONDS).alias("fetched_at"),
        *[listed(f"categories_{c}") for c in ("direct", "level1", "level2", "all")],
        *[F.coalesce(f"taxonomy_l{i}", F.lit("")).alias(f"taxonomy_l{i}") for i in (1, 2, 3)],
    )


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    source = dict(df.dtypes)[field.name]
    if isinstance(field.dataType, T.ArrayType) and source == "string":
        return F.from_json(field.name, field.dataType)
    return F.col(field.name).try_cast(field.dataType)


def apply_schema_contract(df: DataFrame, schema: T.StructType = ARTICLES) -> DataFrame:
    """``df`` with exactly the contract's columns and types; what cannot be read is null."""
    return df.select(*[_coerced(df, f).alias(f.name) for f in schema])


def contract_violations(df: DataFrame, schema: T.StructType = ARTICLES) -> DataFrame:
    """Values lost by the contract, ``(field, violations)`` for every field, from one pass."""
    lost = [
        F.count_if(F.col(f.name).isNotNull() & _coerced(df, f).isNull()) if f.name in df.columns else F.lit(0)
        for f in schema
    ]
    counted = df.agg(*[c.cast("long").alias(f.name) for c, f in zip(lost, schema)])
    return counted.unpivot([], [f.name for f in schema], "field", "violations")


def read_records(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Evaluation records as JSON lines: ``(records, unreadable lines)``.

    The columns are those of ``kind``; unlisted fields are kept as text in the map ``extra``.
    """
    known = T.StructType.fromDDL(RECORDS[kind])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    fields = F.from_json("value", "map<string,string>")
    parsed = lines.select(
        "value",
        F.from_json("value", RECORDS[kind]).alias("r"),
        F.map_filter(fields, lambda name, _: ~name.isin(known.names)).alias("extra"),
    )
    readable = F.col("extra").isNotNull()
    return parsed.filter(readable).select("r.*", "extra"), parsed.filter(~readable).select("value")


def read_pages_table(spark: SparkSession, path: str, after: int | None = None, ordered: bool = False) -> DataFrame:
    """The article table; keys after ``after`` are cut at the scan, order is by key on demand."""
    df = spark.read.parquet(path)
    if after is not None:
        df = df.filter(F.col("page_id") > after)
    return df.orderBy("page_id") if ordered else df


def read_pages_jdbc(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options):
    """The article table of a database, read in parallel ranges of the key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="page_id", lowerBound=lower, upperBound=upper)
        .options(numPartitions=partitions, fetchsize=options.pop("fetchsize", 1000), **options)
        .load()
    )
