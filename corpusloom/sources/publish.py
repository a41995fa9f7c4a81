"""Dated snapshots behind an alias.

A catalogue folder holds the snapshots, a small file for every name in use, and for every alias
numbered files, the greatest of which names its current snapshot. Both kinds are created only if
absent, so two publishers never share a name or a number, and no clock decides. Switching an
alias is one such file, so a failed load leaves the alias where it was. Old snapshots stay for
comparison.
"""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import claim_path, matching_paths, materialize

# Snapshot names are prefix-yyyymmdd, then -1 to -999 on collision.
DATE_FORMAT = "%Y%m%d"
LAST_SEQUENCE = 999


def _switches(spark: SparkSession, root: str, alias: str) -> list[str]:
    """The numbered files of an alias, the newest first."""
    return matching_paths(spark, f"{root}/_aliases/{quote(alias, safe='')}/*")[::-1]


def claim_name(spark: SparkSession, root: str, prefix: str, day: str | None = None) -> str:
    """The first free dated name, taken for the caller."""
    base = f"{prefix}-{day or datetime.now(timezone.utc).strftime(DATE_FORMAT)}"
    for number in range(LAST_SEQUENCE + 1):
        name = f"{base}-{number}" if number else base
        if claim_path(spark, f"{root}/_names/{name}", name):
            return name
    raise RuntimeError(f"{root}: all {LAST_SEQUENCE + 1} snapshot names of {base} are in use")


def switch_alias(spark: SparkSession, root: str, alias: str, name: str) -> None:
    """Point the alias to a snapshot; the switch that takes the greatest number holds."""
    found = _switches(spark, root, alias)
    number = int(found[0].rsplit("/", 1)[1]) + 1 if found else 0
    while not claim_path(spark, f"{root}/_aliases/{quote(alias, safe='')}/{number:012d}", name):
        number += 1


def current_snapshot(spark: SparkSession, root: str, alias: str) -> str | None:
    """Name of the snapshot the alias points to."""
    for path in _switches(spark, root, alias):
        row = spark.read.text(path).first()
        if row:  # a publisher that was lost in between has left an empty file
            return row["value"]
    return None


def read_alias(spark: SparkSession, root: str, alias: str, view: bool = False) -> DataFrame:
    """The current snapshot of an alias, also as a temporary view on demand."""
    name = current_snapshot(spark, root, alias)
    if name is None:
        raise RuntimeError(f"nothing published as {alias}")
    df = spark.read.parquet(f"{root}/{name}")
    if view:
        df.createOrReplaceTempView(alias)
    return df


def publish_snapshot(
    df: DataFrame, root: str, alias: str, prefix: str, day: str | None = None, cluster_by: list[str] | None = None
) -> tuple[str, int]:
    """Load ``df`` into a new snapshot and, if it holds rows, point the alias to it.

    The row count comes from the write itself. ``cluster_by`` range-partitions and sorts the
    files, so that min/max statistics skip them for filters on those columns; finding the
    ranges takes a read of its own, so ``df`` is stored first.
    """
    spark = df.sparkSession
    name = claim_name(spark, root, prefix, day)
    if cluster_by:
        df = materialize(df, "snapshot")  # read twice: once to find the ranges
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(f"{root}/{name}")
    rows = seen.get["rows"]
    if rows > 0:
        switch_alias(spark, root, alias, name)
    return name, rows
