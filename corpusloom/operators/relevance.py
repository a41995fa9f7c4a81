"""Relevance evaluation: judgements, candidates, ranked hits, metrics, conversations.

The formulas are the usual public ones: precision, recall, reciprocal rank, discounted
cumulative gain with gain ``2^rating - 1``, and expected reciprocal rank (Chapelle et al.
2009). An unrated hit counts as not relevant, a rating of 1 or more as relevant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import salted_join
from corpusloom.sources.records import delete_by_key, stamp_upsert

# The fields that identify a judgement; the separator between a sample's seed and key.
JUDGEMENT_KEY = ["workspace_id", "scenario_id", "index", "doc_id"]
SEED_SEPARATOR = "|"

SCENARIO = ["workspace_id", "scenario_id"]
LIST = ["workspace_id", "strategy_id", "scenario_id"]
HIT = ["workspace_id", "scenario_id", "index", "doc_id"]
RELEVANT = 1


def judgement_id() -> Column:
    """Id of a judgement, derived from what it judges.

    Each part is preceded by its length and a null part is a dash, so that no two judgements
    share an id, whatever characters their parts hold.
    """
    part = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*(part(F.col(c).cast("string")) for c in JUDGEMENT_KEY)), 256)


def set_judgements(base: DataFrame, delta: DataFrame, seq: str, user: str, via: str = "server") -> DataFrame:
    """Insert or overwrite ratings; an id given by the caller is ignored."""
    identified = delta.withColumn("_id", judgement_id())
    return stamp_upsert(base, identified, ["_id"], seq, user, via)


def unset_judgements(base: DataFrame, ids: DataFrame) -> DataFrame:
    """Delete ratings by id."""
    return delete_by_key(base, ids, ["_id"])


def validate_workspace(records: DataFrame, workspace: str) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: another workspace's records are refused, absent ones filled in.

    Rating scale ends given as text become integers; text that is no integer is refused too.
    """
    ends = ["scale_min", "scale_max"]
    checked = records.withColumns({f"_{e}": F.col(e).try_cast("int") for e in ends})
    problem = F.when(F.col("workspace_id") != workspace, F.lit("record of another workspace"))
    for end in ends:
        problem = problem.when(F.col(end).isNotNull() & F.col(f"_{end}").isNull(), F.lit(f"{end} cannot be read as an integer"))
    checked = checked.withColumn("problem", problem)
    accepted = (
        checked.filter(F.col("problem").isNull())
        .withColumn("workspace_id", F.coalesce("workspace_id", F.lit(workspace)))
        .withColumns({e: F.col(f"_{e}") for e in ends})
        .drop("problem", *[f"_{e}" for e in ends])
    )
    rejected = checked.filter(F.col("problem").isNotNull()).drop(*[f"_{e}" for e in ends])
    return accepted, rejected


def choose(records: DataFrame, key: str, ids: list[str] | None = None, tags: list[str] | None = None) -> DataFrame:
    """Records named by id or carrying one of the tags; all when neither is given."""
    if not ids and not tags:
        return records
    chosen = F.lit(False)
    if ids:
        chosen = chosen | F.col(key).isin(ids)
    if tags:
        chosen = chosen | F.arrays_overlap("tags", F.array(*map(F.lit, tags)))
    return records.filter(chosen)


def select_candidates(scenarios: DataFrame, strategies: DataFrame) -> DataFrame:
    """``(workspace_id, strategy_id, scenario_id)`` where the scenario gives every parameter.

    Records with the same parameter list behave alike, so lists are compared first: a
    strategy list fits a scenario list that holds all its parameters, counted over an
    equi-join on the parameter. Records then meet through the fitting lists. A strategy
    without parameters fits every list of its workspace; a null list is an empty one. A
    parameter list that very many scenarios share is a hot key and is spread.
    """
    given = F.array_sort(F.array_distinct(F.coalesce("params", F.array().cast("array<string>"))))
    sc = scenarios.select("workspace_id", "scenario_id", given.alias("sc_params"))
    st = strategies.select("workspace_id", "strategy_id", given.alias("st_params"))

    st_lists, sc_lists = (r.select("workspace_id", n).distinct() for r, n in ((st, "st_params"), (sc, "sc_params")))
    sharing = (
        st_lists.withColumn("param", F.explode("st_params"))
        .join(sc_lists.withColumn("param", F.explode("sc_params")), ["workspace_id", "param"])
        .groupBy("workspace_id", "st_params", "sc_params")
        .agg(F.count(F.lit(1)).alias("shared"))
        .filter(F.col("shared") == F.size("st_params"))
        .drop("shared")
    )
    free = st_lists.filter(F.size("st_params") == 0).join(sc_lists, "workspace_id")
    fits = sharing.unionByName(free)
    runnable = st.join(fits, ["workspace_id", "st_params"]).select("workspace_id", "sc_params", "strategy_id")
    return salted_join(sc, runnable, ["workspace_id", "sc_params"], spread=["scenario_id"], how="inner").select(
        "workspace_id", "strategy_id", "scenario_id"
    )


def sample_scenarios(scenarios: DataFrame, size: int, seed: str, key: str = "scenario_id") -> DataFrame:
    """At most ``size`` scenarios, the same ones for the same seed on any cluster."""
    order = F.md5(F.concat(F.lit(seed + SEED_SEPARATOR), F.col(key).cast("string")))
    return scenarios.orderBy(order, key).limit(size)


def render_strategy(source: Column, values: Column) -> Column:
    """The template with ``{{param}}`` filled from a map; unknown parameters stay.

    The template is cut into placeholders and other text once, so a filled-in value is never
    searched for placeholders again.
    """
    pieces = F.regexp_extract_all(source, F.lit(r"(\{\{\w+\}\}|[^{]+|\{)"), F.lit(1))
    name = lambda piece: F.regexp_extract(piece, r"^\{\{(\w+)\}\}$", 1)
    value = lambda piece: F.when(name(piece) != "", F.try_element_at(values, name(piece)))
    filled = F.transform(pieces, lambda piece: F.coalesce(value(piece), piece))
    return F.array_join(filled, "")


def ranked_hits(
    docs: DataFrame, scores: dict[str, Column], k: int, scenario: str, index: str, key: str = "doc_id", workspace: str = "workspace_id"
) -> DataFrame:
    """``(workspace_id, strategy_id, scenario_id, index, doc_id, score, rank)``: the top ``k`` of each list.

    A strategy is a named scoring Column. Documents are read once for all strategies, and
    ranking keeps ``k`` rows per list and task before the shuffle, so a scenario that covers a
    large share of the corpus is no hot spot.
    """
    scored = docs.select(
        F.col(workspace).alias("workspace_id"),
        F.col(scenario).alias("scenario_id"),
        F.col(key).alias("doc_id"),
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("strategy_id"), c.cast("double").alias("score")) for n, c in scores.items()])
        ),
    )
    rank = F.row_number().over(Window.partitionBy(*LIST).orderBy(F.desc("score"), F.asc("doc_id")))
    return (
        scored.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select(*LIST, F.lit(index).alias("index"), "doc_id", "score", "rank")
    )


def hits_left_judgements(hits: DataFrame, judgements: DataFrame) -> DataFrame:
    """Hits with their rating, null when unrated."""
    return hits.join(judgements.select(*HIT, "rating"), HIT, "left")


def unrated_hits(hits: DataFrame, judgements: DataFrame) -> DataFrame:
    """Hits without a judgement."""
    return hits.join(judgements.select(*HIT), HIT, "left_anti")


def unrated_docs(hits: DataFrame, judgements: DataFrame) -> DataFrame:
    """Per unrated document of a workspace: times returned, and by how many strategies and scenarios.

    Which ones they are is in ``unrated_hits``, one row each: a popular document is returned
    for very many scenarios, too many for one row.
    """
    return (
        unrated_hits(hits, judgements)
        .groupBy("workspace_id", "index", "doc_id")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.count_distinct("strategy_id").alias("strategies"),
            F.count_distinct("scenario_id").alias("scenarios"),
        )
    )


def _gain(rating: Column) -> Column:
    return F.pow(F.lit(2.0), F.coalesce(rating, F.lit(0))) - 1


def _discounted(rating: Column, rank: Column) -> Column:
    return _gain(rating) / F.log2(rank + 1)


def _relevant(rating: Column) -> Column:
    return F.coalesce(rating, F.lit(0)) >= RELEVANT


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _reached(stop: Column) -> Column:
    """Probability that a reader comes as far as this rank: the product over earlier ranks."""
    earlier = Window.partitionBy(*LIST).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return F.exp(F.coalesce(F.sum(F.ln(1 - stop)).over(earlier), F.lit(0.0)))


def relevant_total(judgements: DataFrame) -> DataFrame:
    """Relevant documents of each scenario."""
    return judgements.groupBy(*SCENARIO).agg(F.count_if(_relevant(F.col("rating"))).alias("total"))


def precision_at_k(rated: DataFrame) -> DataFrame:
    """Relevant hits among the hits returned."""
    return rated.groupBy(*LIST).agg(F.avg(_relevant(F.col("rating")).cast("double")).alias("precision"))


def recall_at_k(rated: DataFrame, judgements: DataFrame) -> DataFrame:
    """Relevant hits among all relevant documents of the scenario; 0 when there are none."""
    found = rated.groupBy(*LIST).agg(F.count_if(_relevant(F.col("rating"))).alias("found"))
    return found.join(relevant_total(judgements), SCENARIO, "left").select(
        *LIST, _share("found", "total").alias("recall")
    )


def mrr_at_k(rated: DataFrame) -> DataFrame:
    """One over the rank of the first relevant hit, else 0."""
    first = F.min(F.when(_relevant(F.col("rating")), F.col("rank")))
    return rated.groupBy(*LIST).agg(F.coalesce(1 / first, F.lit(0.0)).alias("mrr"))


def dcg_at_k(rated: DataFrame) -> DataFrame:
    """Discounted cumulative gain."""
    return rated.groupBy(*LIST).agg(F.sum(_discounted(F.col("rating"), F.col("rank"))).alias("dcg"))


def ideal_dcg(judgements: DataFrame, k: int) -> DataFrame:
    """DCG of the best ``k`` ratings of each scenario.

    Ratings are counted first: only ``(scenario, rating)`` counts are ranked, then the ranks
    1..k are laid over the running count.
    """
    counts = judgements.groupBy(*SCENARIO, "rating").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy(*SCENARIO).orderBy(F.desc("rating"))
    before = F.coalesce(F.sum("n").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("before", before).filter(F.col("before") < k)
    ranks = placed.withColumn(
        "rank", F.explode(F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("n"), F.lit(k))))
    )
    return ranks.groupBy(*SCENARIO).agg(F.sum(_discounted(F.col("rating"), F.col("rank"))).alias("ideal"))


def ndcg_at_k(rated: DataFrame, judgements: DataFrame, k: int) -> DataFrame:
    """DCG over the scenario's best possible DCG; 0 when that is 0."""
    return (
        dcg_at_k(rated)
        .join(ideal_dcg(judgements, k), SCENARIO, "left")
        .select(*LIST, _share("dcg", "ideal").alias("ndcg"))
    )


def err_at_k(rated: DataFrame, max_rating: int) -> DataFrame:
    """Expected reciprocal rank for a rating scale that ends at ``max_rating``."""
    stop = _gain(F.col("rating")) / (2.0**max_rating)
    return (
        rated.select(*LIST, (stop * _reached(stop) / F.col("rank")).alias("_share"))
        .groupBy(*LIST)
        .agg(F.sum("_share").alias("err"))
    )


METRICS = ["precision", "recall", "mrr", "dcg", "ndcg", "err"]


def metrics(rated: DataFrame, judgements: DataFrame, k: int, max_rating: int) -> DataFrame:
    """All six metrics of every list, from one pass over the rated hits."""
    rating, rank = F.col("rating"), F.col("rank")
    stop = _gain(rating) / (2.0**max_rating)
    per_list = (
        rated.withColumn("_stop", stop)
        .withColumn("_reached", _reached(F.col("_stop")))
        .groupBy(*LIST)
        .agg(
            F.avg(_relevant(rating).cast("double")).alias("precision"),
            F.count_if(_relevant(rating)).alias("_found"),
            F.coalesce(1 / F.min(F.when(_relevant(rating), rank)), F.lit(0.0)).alias("mrr"),
            F.sum(_discounted(rating, rank)).alias("dcg"),
            F.sum(F.col("_stop") * F.col("_reached") / rank).alias("err"),
        )
    )
    per_scenario = relevant_total(judgements).join(ideal_dcg(judgements, k), SCENARIO)
    return per_list.join(per_scenario, SCENARIO, "left").select(
        *LIST, "precision", _share("_found", "total").alias("recall"), "mrr", "dcg", _share("dcg", "ideal").alias("ndcg"), "err"
    )


def evaluation_summary(per_list: DataFrame) -> DataFrame:
    """Mean of every metric per strategy of a workspace and over all its lists (``strategy_id`` null)."""
    sums = per_list.groupBy("workspace_id", "strategy_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in METRICS]
    )
    # One row per strategy, or the total of the workspace.
    either = F.explode(F.array(F.col("strategy_id"), F.lit(None)))
    return sums.withColumn("strategy_id", either).groupBy("workspace_id", "strategy_id").agg(
        F.sum("n").alias("searches"), *[(F.sum(m) / F.sum("n")).alias(m) for m in METRICS]
    )


def latest_evaluations(evaluations: DataFrame, benchmark: str, n: int) -> DataFrame:
    """The newest ``n`` evaluations of a benchmark."""
    return (
        evaluations.filter(F.col("benchmark_id") == benchmark)
        .orderBy(F.desc("created_at"), F.asc("evaluation_id"))
        .limit(n)
    )


def flatten_conversations(conversations: DataFrame, keys: list[str]) -> DataFrame:
    """One row per result of each step of each round; empty rounds and steps keep a row.

    ``rounds`` is an array of structs with ``steps``, an array of structs with ``results``.
    """
    rounds = conversations.select(*keys, F.posexplode_outer("rounds").alias("round_no", "r"))
    steps = rounds.select(*keys, "round_no", "r.status", F.posexplode_outer("r.steps").alias("step_no", "s"))
    return steps.select(
        *keys, "round_no", "status", "step_no", "s.type", F.posexplode_outer("s.results").alias("result_no", "result")
    )


def model_usage(rounds: DataFrame) -> DataFrame:
    """Calls, tokens and token times per model."""
    return rounds.groupBy("inference_id").agg(
        F.sum("llm_calls").alias("llm_calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.avg("time_to_first_token").alias("avg_time_to_first_token"),
        F.max("time_to_last_token").alias("max_time_to_last_token"),
    )
