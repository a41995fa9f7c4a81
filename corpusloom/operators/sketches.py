"""Facets on stored sketches: heavy hitters and distinct counts that merge up a hierarchy.

A leaf of the hierarchy keeps one small row: its row count, a sketch of its most frequent values
and one of its distinct values. Levels above, and later loads, merge rows instead of reading data
again. Sizes are bounded by the parameters, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values that a heavy-hitter sketch tracks, and the binary logarithm of the buckets of a distinct count.
TRACKED, LG_BUCKETS = 1024, 12
#: Standard error of the distinct count, and how many of them its bound allows.
HLL_ERROR, DEVIATIONS = 1.04 / (2 ** (LG_BUCKETS / 2)), 4.0


def sketch_leaves(rows: DataFrame, levels: list[str], value: str, tracked: int = TRACKED) -> DataFrame:
    """``(levels, rows, frequent, distinct)``: one row of sketches per leaf. Null values are not counted."""
    return rows.groupBy(*levels).agg(
        F.count(value).alias("rows"),
        F.call_function("approx_top_k_accumulate", F.col(value), F.lit(tracked)).alias("frequent"),
        F.hll_sketch_agg(value, LG_BUCKETS).alias("distinct"),
    )


def merge_up(leaves: DataFrame, levels: list[str], tracked: int = TRACKED) -> DataFrame:
    """The sketches of a level, or of the same leaves from several loads, from those of the leaves."""
    return leaves.groupBy(*levels).agg(
        F.sum("rows").alias("rows"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def estimates(sketches: DataFrame, levels: list[str], k: int) -> DataFrame:
    """``(levels, rows, n_distinct, value, n)``: the estimated ``k`` most frequent values and the number of distinct ones.

    Only values that are surely more frequent than the sketch's error are named; where there are
    none, a row of null value stays.
    """
    top = F.explode_outer(F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(k))).alias("t")
    return sketches.select(*levels, "rows", F.hll_sketch_estimate("distinct").alias("n_distinct"), top).select(
        *levels, "rows", "n_distinct", F.col("t.item").alias("value"), F.col("t.count").alias("n")
    )


def frequency_error(rows, tracked: int = TRACKED):
    """How far an estimated frequency may be off: a share of the rows that the tracked values allow."""
    return F.ceil(3.5 * rows / tracked)


def distinct_error(exact):
    """How far an estimated distinct count may be off."""
    return F.greatest(F.lit(1.0), DEVIATIONS * HLL_ERROR * exact)
