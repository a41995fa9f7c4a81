"""Packing rows into parts of a limited number of bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Caps of an export file and of one bulk request, in bytes.
FILE_CAP = 100 * 1024 * 1024
REQUEST_CAP = 10 * 1024 * 1024

#: Keys per bucket. A bucket is packed in one task, holding two integers per row.
BUCKET_KEYS = 1 << 18


def part_numbers(rows: DataFrame, size: str, cap: int, key: str, bucket_keys: int) -> DataFrame:
    """``(key, bucket, part)`` of every row, from keys and sizes alone.

    Keys are unique, so a bucket, a range of ``bucket_keys`` keys, holds at most that many
    rows whatever the data looks like, and only key and size travel to it. The functions are
    local, so that they travel by value and workers need no copy of this package.
    """

    def parts(sizes: np.ndarray) -> np.ndarray:
        """Part of each row by next-fit: a row that no longer fits the open part opens the next."""
        ends = np.cumsum(sizes)
        opens = np.zeros(len(sizes), dtype=np.int64)
        at = 0
        while at < len(sizes):
            used = ends[at - 1] if at else 0
            at = max(int(np.searchsorted(ends, used + cap, side="right")), at + 1)
            if at < len(sizes):
                opens[at] = 1
        return np.cumsum(opens)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        return pd.DataFrame({key: group["key"], "bucket": group["bucket"], "part": parts(group["size"].to_numpy())})

    narrow = rows.select(
        _bucket(key, bucket_keys).alias("bucket"), F.col(key).alias("key"), F.col(size).cast("long").alias("size")
    )
    kind = rows.schema[key].dataType.simpleString()
    return narrow.groupBy("bucket").applyInPandas(pack, f"`{key}` {kind}, bucket long, part long")


def _bucket(key: str, bucket_keys: int) -> Column:
    return F.expr(f"`{key}` div {bucket_keys} - if(`{key}` < 0 and `{key}` % {bucket_keys} != 0, 1, 0)").cast("long")


def pack_by_bytes(
    rows: DataFrame, size: str, cap: int = FILE_CAP, key: str = "page_id", bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """``rows`` with ``bucket`` and ``part``, by next-fit in key order within each bucket of keys.

    A part never exceeds ``cap`` unless it is one oversized row; ``cap <= 0`` packs nothing and
    leaves both null. Each bucket ends its last part, hence at most one extra part per bucket
    against a single pass. Rows meet their part by their key, so no bucket of rows gathers. A
    null key stops the job: it has no place in the order.
    """
    if cap <= 0:
        return rows.withColumns({c: F.lit(None).cast("long") for c in ("bucket", "part")})
    stop = F.raise_error(F.lit(f"packing by {key}: a row has no key"))
    named = rows.withColumn(key, F.when(F.col(key).isNull(), stop).otherwise(F.col(key)))
    return named.join(part_numbers(named, size, cap, key, bucket_keys), key, "left")


def with_part_no(
    rows: DataFrame, size: str, cap: int = FILE_CAP, key: str = "page_id", bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """``rows`` with the text column ``part_no``, whose order is the key order of the parts; null without a cap."""
    packed = pack_by_bytes(rows, size, cap, key, bucket_keys)
    number = F.when(F.col("part").isNotNull(), F.format_string("%08d-%06d", "bucket", "part"))
    return packed.withColumn("part_no", number).drop("bucket", "part")


def pack_requests(
    docs: DataFrame, size: str, cap: int = REQUEST_CAP, key: str = "page_id", file: str = "part_no", bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """``docs`` with ``bucket`` and ``request``: the bulk requests of each file and bucket of keys, by next-fit in key order.

    Files of a capped export lie in one bucket each. An export without a cap has no files, so
    its requests are packed bucket by bucket; either way only key and size of one bucket meet
    in a task, and documents meet their request by key. A request exceeds ``cap`` only if it is
    one oversized document.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        request, used, out = 0, 0, []
        for i, n in enumerate(group["size"].tolist()):
            if i and used + n > cap:
                request, used = request + 1, 0
            used += n
            out.append(request)
        return pd.DataFrame({key: group["key"], "bucket": group["bucket"], "request": out})

    bucket = _bucket(key, bucket_keys).alias("bucket")
    narrow = docs.select(file, bucket, F.col(key).alias("key"), F.col(size).cast("long").alias("size"))
    kind = docs.schema[key].dataType.simpleString()
    packed = narrow.groupBy(file, "bucket").applyInPandas(pack, f"`{key}` {kind}, bucket long, request long")
    return docs.join(packed, key, "left")
