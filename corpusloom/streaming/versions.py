"""The newest version of every key of a stream, by event time, with late rows set aside.

A state store holds for each key the time and number of its newest version. A row that is older
than the watermark is late: it goes to a table of its own and changes nothing. A row that is no
newer than its key's version has been overtaken or is a repeat. Everything is written batch by
batch under the batch's id, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from corpusloom.session import matching_paths

NEWEST, OVERTAKEN, REPEATED, LATE = "newest", "overtaken", "repeated", "late"


def _judge(columns: list[str], time: str, seq: str):
    """The function of one key's rows of a batch and its state; local, so that it travels by value."""

    def judged(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else None
        limit = state.getCurrentWatermarkMs()
        rows = pd.concat(list(batches), ignore_index=True).sort_values([time, seq], ignore_index=True)
        micros = rows[time].astype("datetime64[us]").astype("int64")
        fate, last = [], None
        for i, (at, number) in enumerate(zip(micros.tolist(), rows[seq].tolist(), strict=True)):
            if at < limit * 1000:
                fate.append(LATE)
            elif held is not None and (at, number) == held:
                fate.append(REPEATED)
            elif held is not None and (at, number) < held:
                fate.append(OVERTAKEN)
            else:
                if last is not None:
                    fate[last] = OVERTAKEN
                held, last = (at, number), i
                fate.append(NEWEST)
        if last is not None:
            state.update(held)
        yield rows.assign(fate=fate)[[*columns, "fate"]]

    return judged


def stream_versions(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    key: str,
    time: str,
    seq: str,
    delay: str,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Read new JSON-lines files, judge each row against its key's newest version, store all with their ``fate``, then stop.

    Rows without key, time or number are left out. A key's rows of one batch are sorted in one task;
    a key's rows over all batches never meet.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
        .filter(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(seq).isNotNull())
        .withWatermark(time, delay)
    )
    out = StructType.fromDDL(schema).add("fate", "string")
    judged = rows.groupBy(key).applyInPandasWithState(
        _judge(StructType.fromDDL(schema).names, time, seq), out, "time long, seq long", "update", GroupStateTimeout.NoTimeout
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("fate").parquet(f"{target}/batch_id={batch_id}")

    return judged.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_versions(spark: SparkSession, target: str) -> DataFrame | None:
    """All stored rows with ``fate`` and ``batch_id``; none before the first batch."""
    found = matching_paths(spark, f"{target}/batch_id=*/fate=*")
    return spark.read.option("basePath", target).parquet(*found) if found else None


def newest_versions(versions: DataFrame, key: str) -> DataFrame:
    """The newest version of every key: its last one that was the newest of its batch."""
    last = versions.filter(F.col("fate") == NEWEST)
    return last.groupBy(key).agg(F.max_by(F.struct("*"), "batch_id").alias("v")).select("v.*").drop("fate", "batch_id")
