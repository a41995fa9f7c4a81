"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize

#: Edges per file of a round, so that small rounds write few files.
EDGES_PER_FILE = 20_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v): neighbours are joined to the least node around.

    Least neighbours are counted before they are joined, so that a node with very many edges
    is no group in a task; the join may be split by Spark like any other.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (u, v) the least node that it reaches.

    Each round is written to the shared folder, which also cuts the lineage. Rounds grow with
    the logarithm of the longest chain; only two counts per round reach the driver.
    """
    edges = materialize(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    seen, count = None, edges.count()
    while True:
        stars = _star(_star(edges, large=True), large=False)
        edges = materialize(stars.coalesce(count // EDGES_PER_FILE + 1), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen, count = now, now[0]
