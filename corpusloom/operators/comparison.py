"""Whether one strategy is better than another: paired tests over the scenarios that both were run on.

Two strategies of a workspace are compared by the differences of a metric, one per scenario.
A randomisation test turns the signs of the differences over at random and asks how often the
sum comes out as far from zero as it did. A Poisson bootstrap weighs scenarios at random and
gives an interval of the mean difference. Signs and weights come from a hash of the scenario and the
number of the round, so they are the same on any partitioning; sums are decimals.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.relevance import METRICS
from corpusloom.session import materialize

ROUNDS = 200
#: Share of the rounds that lie outside of the interval, on both sides together.
OUTSIDE = 0.05
VALUE = "decimal(20,9)"
#: Hexadecimal digits of a hash that are compared, and the largest weight.
DIGITS, MOST = 8, 8


def poisson_limits() -> list[str]:
    """The hash digits from which on a weight is at least 1, 2, ...: the distribution of Poisson with mean 1."""
    shares = [sum(exp(-1) / factorial(j) for j in range(k)) for k in range(1, MOST + 1)]
    return [f"{int(share * 16**DIGITS):0{DIGITS}x}" for share in shares]


def _digits(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def _sign(digits: Column) -> Column:
    return F.when(F.substring(digits, 1, 1) < "8", F.lit(1)).otherwise(F.lit(-1))


def _weight(digits: Column) -> Column:
    part = F.substring(digits, 2, DIGITS)
    return sum((F.when(part >= limit, F.lit(1)).otherwise(F.lit(0)) for limit in poisson_limits()[1:]), F.when(part >= poisson_limits()[0], F.lit(1)).otherwise(F.lit(0)))


def paired_differences(per_list: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """``(workspace_id, strategy_a, strategy_b, metric, scenario_id, difference)``: b less a, for a before b."""
    long = per_list.select(
        "workspace_id", "scenario_id", "strategy_id", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast(VALUE).alias("value")) for m in metrics))).alias("m")
    ).select("workspace_id", "scenario_id", "strategy_id", "m.*")
    a = long.select("workspace_id", "scenario_id", "metric", F.col("strategy_id").alias("strategy_a"), F.col("value").alias("_a"))
    b = long.select("workspace_id", "scenario_id", "metric", F.col("strategy_id").alias("strategy_b"), F.col("value").alias("_b"))
    both = a.join(b, ["workspace_id", "scenario_id", "metric"]).filter("strategy_a < strategy_b")
    return both.select(
        "workspace_id", "strategy_a", "strategy_b", "metric", "scenario_id", (F.col("_b") - F.col("_a")).cast(VALUE).alias("difference")
    )


def compare_strategies(per_list: DataFrame, metrics: list[str] = METRICS, rounds: int = ROUNDS, seed: str = "0") -> DataFrame:
    """``(workspace_id, strategy_a, strategy_b, metric, scenarios, difference, p_value, low, high)`` for every pair.

    ``difference`` is the mean of b less a. ``p_value`` is the share of rounds, the real signs
    among them, whose sum is at least as far from zero. ``low`` and ``high`` hold all but
    ``OUTSIDE`` of the bootstrap's means. Each difference meets all rounds in its own task; what is
    shuffled is a row per task, pair, metric and round.
    """
    pair = ["workspace_id", "strategy_a", "strategy_b", "metric"]
    differences = materialize(paired_differences(per_list, metrics), "differences")
    whole = differences.groupBy(*pair).agg(F.count("*").alias("scenarios"), F.sum("difference").alias("total"))
    digits = _digits(F.lit(seed), F.col("workspace_id"), F.col("scenario_id"), F.col("round").cast("string"))
    drawn = differences.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("digits", digits)
    per_round = drawn.groupBy(*pair, "round").agg(
        F.sum(F.col("difference") * _sign(F.col("digits"))).alias("turned"),
        F.sum(F.col("difference") * _weight(F.col("digits"))).alias("weighed"),
        F.sum(_weight(F.col("digits"))).alias("weight"),
    )
    means = per_round.join(whole, pair).withColumn(
        "mean", F.when(F.col("weight") > 0, F.col("weighed").cast("double") / F.col("weight")).otherwise(F.lit(0.0))
    )
    # One row a round is left of each pair and metric.
    ranked = means.withColumn("rank", F.row_number().over(Window.partitionBy(*pair).orderBy("mean")))
    first, last = int(rounds * OUTSIDE / 2) + 1, rounds - int(rounds * OUTSIDE / 2)
    return ranked.groupBy(*pair).agg(
        F.max("scenarios").alias("scenarios"),
        (F.max("total").cast("double") / F.max("scenarios")).alias("difference"),
        ((F.count_if(F.abs("turned") >= F.abs("total")) + 1) / (rounds + 1)).alias("p_value"),
        F.max(F.when(F.col("rank") == first, F.col("mean"))).alias("low"),
        F.max(F.when(F.col("rank") == last, F.col("mean"))).alias("high"),
    )
