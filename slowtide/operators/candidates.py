"""Candidate rewrites: validity, order, verification, and the events that record them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions.numeric import half_even
from slowtide.functions.text import answer_sql, clean_candidate, strategy
from slowtide.operators.runs import first_seen

# The slow gate and the number of candidates per statement.
P_SLOW_GATE = 0.5
CANDIDATES = 3


def gate(scored: DataFrame, minimum: float = P_SLOW_GATE) -> DataFrame:
    """Statements the model holds for slow; exactly the minimum passes."""
    return scored.filter(F.col("p_slow") >= minimum)


def extract_candidates(answers: DataFrame, statement: str, position: str, n: int = CANDIDATES) -> DataFrame:
    """Valid, distinct candidates in order of generation, at most n per statement.

    `answers` has `query` (the slow statement) and `raw` (a generated answer).
    """
    cleaned = answers.withColumn("sql", clean_candidate(answer_sql(F.col("raw"))))
    # filtered after the window: before it, Spark would evaluate the whole extraction a second time
    distinct = first_seen(cleaned, F.struct(statement, "sql"), [F.col(position)]).filter(F.col("sql").isNotNull())
    nth = F.row_number().over(Window.partitionBy(statement).orderBy(position))
    return (
        distinct.withColumn("nth__", nth)
        .filter(F.col("nth__") <= n)
        .withColumn("strategy", strategy(F.col("query"), F.col("sql")))
        .drop("nth__", "raw")
    )


def rank_candidates(candidates: DataFrame, statement: str, position: str, baseline: str) -> DataFrame:
    """Adds predicted speed-up and rank; equal speed-ups keep the order of generation.

    `candidates` holds at most CANDIDATES rows per statement, with `predicted_ms` and the
    statement's own time in `baseline`.
    """
    faster = candidates.withColumn("predicted_speedup_ms", F.col(baseline) - F.col("predicted_ms"))
    order = Window.partitionBy(statement).orderBy(F.col("predicted_speedup_ms").desc(), F.col(position).asc())
    return faster.withColumn("rank", F.row_number().over(order))


def strategy_of(ranked: DataFrame, labels: DataFrame, statement: str) -> DataFrame:
    """Look up each ranked candidate's label by its text; missing labels become empty."""
    named = labels.select(statement, "sql", "strategy")
    return ranked.drop("strategy").join(named, [statement, "sql"], "left").fillna({"strategy": ""})


def verify(ranked: DataFrame, measured: DataFrame, statement: str, baseline: str) -> DataFrame:
    """The top candidate of each statement with its measured times.

    Only a candidate predicted to be faster is measured. `measured` has one row per statement and
    `sql` with `cold_ms`, `warm_ms` and the runs (`all_runs_ms`); both times are rounded to one decimal before the speed-up is taken.
    """
    top = ranked.filter("rank = 1")
    times = measured.select(
        F.col(statement).alias("measured_statement__"),
        F.col("sql").alias("measured_sql__"),
        half_even(F.col("cold_ms"), 1).alias("verified_cold_ms"),
        half_even(F.col("warm_ms"), 1).alias("verified_warm_ms"),
        F.col("all_runs_ms"),
    )
    same = (F.col(statement) == F.col("measured_statement__")) & (F.col("sql") == F.col("measured_sql__"))
    tried = same & (F.col("predicted_speedup_ms") > 0)
    return top.join(times, tried, "left").drop("measured_statement__", "measured_sql__").withColumn(
        "measured_speedup_ms", F.col(baseline) - F.col("verified_warm_ms")
    )


def wins(verified: DataFrame) -> DataFrame:
    """What goes into the history: candidates measured faster than the statement."""
    return verified.filter("measured_speedup_ms > 0").select(
        F.col("query").alias("slow_query"), F.col("sql").alias("fix"), F.col("measured_speedup_ms").alias("speedup_ms")
    )


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with `equal`: whether both results hold the same rows equally often.

    A rewrite can win on time and still change the answer; this finds it in one grouping.
    """
    signed = left.withColumn("side__", F.lit(1)).union(right.withColumn("side__", F.lit(-1)))
    differing = signed.groupBy(*left.columns).agg(F.sum("side__").alias("d__")).filter("d__ <> 0")
    return differing.agg((F.count("*") == 0).alias("equal"))


EVENT = "slow_query_handled"
NO_CANDIDATES = "no_candidates"


def reason(strategies: Column) -> Column:
    named = F.filter(strategies, lambda s: s != "")
    return F.concat(F.lit("Query optimization strategies: "), F.array_join(named, ", "))


def assemble_events(
    handled: DataFrame, ranked: DataFrame, verified: DataFrame, statement: str, position: str, source: str
) -> DataFrame:
    """One nested event per statement.

    `handled` has the gated statements with `query`, `mean_exec_time`, `calls`, `p_slow`,
    `predicted_ms`, `plan_total_cost`, `has_seq_scan`, `has_index_scan`, `similar_fix_used` and
    `timestamp`. A statement without candidates becomes a `no_candidates` event.
    """
    shown = F.struct(
        F.col("rank"),
        "sql",
        F.col("strategy"),
        half_even(F.col("predicted_ms"), 2).alias("predicted_ms"),
        half_even(F.col("predicted_speedup_ms"), 2).alias("predicted_speedup_ms"),
    )
    lists = ranked.groupBy(statement).agg(
        F.array_sort(F.collect_list(shown)).alias("ranked__"),
        F.transform(F.array_sort(F.collect_list(F.struct(position, "strategy"))), lambda s: s["strategy"]).alias("named__"),
    )
    checks = verified.select(statement, "verified_cold_ms", "verified_warm_ms", "measured_speedup_ms", "all_runs_ms")
    joined = handled.join(lists, statement, "left").join(checks, statement, "left")
    found = F.col("ranked__").isNotNull()

    def when_found(column):
        return F.when(found, column)

    return joined.select(
        statement,
        F.when(found, EVENT).otherwise(NO_CANDIDATES).alias("type"),
        "timestamp",
        "query",
        when_found(half_even(F.col("mean_exec_time"), 2)).alias("pg_stat_mean_ms"),
        when_found(F.col("calls")).alias("calls"),
        when_found(
            F.struct(
                half_even(F.col("p_slow"), 4).alias("p_slow"),
                half_even(F.col("predicted_ms"), 2).alias("predicted_ms"),
                "plan_total_cost",
                "has_seq_scan",
                "has_index_scan",
            )
        ).alias("model"),
        F.when(~found, F.col("p_slow")).alias("p_slow"),
        F.when(~found, F.col("predicted_ms")).alias("predicted_ms"),
        reason(F.coalesce("named__", F.array().cast("array<string>"))).alias("reason"),
        when_found(F.lit("NONE")).alias("index_suggestion"),
        F.lit(source).alias("llm_source"),
        when_found(F.col("similar_fix_used")).alias("similar_fix_used"),
        F.transform(
            "ranked__",
            lambda r: F.struct(
                r["sql"].alias("sql"),
                r["strategy"].alias("strategy"),
                r["predicted_ms"].alias("predicted_ms"),
                r["predicted_speedup_ms"].alias("predicted_speedup_ms"),
            ),
        ).alias("candidates_ranked"),
        F.when(
            F.col("verified_warm_ms").isNotNull(),
            F.struct(F.col("verified_cold_ms").alias("cold_ms"), F.col("verified_warm_ms").alias("warm_median_ms"), F.col("all_runs_ms")),
        ).alias("top_candidate_verified"),
        half_even(F.col("measured_speedup_ms"), 2).alias("measured_speedup_ms"),
    )
