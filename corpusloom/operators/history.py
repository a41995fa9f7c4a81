"""Values as of a time: what held when something happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    rows: DataFrame, history: DataFrame, key: list[str], at: str, since: str, values: list[str], seq: str | None = None
) -> DataFrame:
    """``rows`` with the ``values`` of the version of their ``key`` that held at their time ``at``.

    A version holds from its time ``since`` on, that time included, until the next one; of
    versions of one time the one of greatest ``seq`` comes last. Before the first version, and
    for unknown keys, the values are null; so they are if the version itself says null, as for a
    value that was taken back. Rows without a time know no version.

    Both tables are laid in one line per key and time, and each row looks back to the last
    version: one shuffle by key, no join on ranges. Rows with a null key keep null values.
    """
    taken = F.struct(*(F.col(f"_h.{v}").alias(v) for v in values))
    versions = history.filter(F.col(since).isNotNull()).select(
        *key,
        F.col(since).alias("_at"),
        F.lit(0).alias("_kind"),
        (F.col(seq) if seq else F.lit(0)).cast("long").alias("_seq"),
        F.struct(*values).alias("_h"),
        F.lit(None).cast(rows.schema).alias("_row"),
    )
    asked = rows.select(
        *key,
        F.col(at).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(0).cast("long").alias("_seq"),
        F.lit(None).cast(history.select(*values).schema).alias("_h"),
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"),
    )
    line = Window.partitionBy(*key).orderBy(F.asc_nulls_first("_at"), "_kind", "_seq").rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(F.col("_kind") == 0, taken), ignorenulls=True).over(line)
    found = versions.unionByName(asked).withColumn("_held", held).filter(F.col("_kind") == 1)
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return found.select("_row.*", *(F.when(known, F.col(f"_held.{v}")).alias(v) for v in values))
