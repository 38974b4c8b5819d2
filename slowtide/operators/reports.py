"""Reports over event logs, evaluation tables and run results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions.numeric import half_even
from slowtide.operators.candidates import EVENT
from slowtide.operators.ordered import quantiles


def normalise_log(events: DataFrame) -> DataFrame:
    """Both shapes of log records as one flat row; records of other types are left out.

    A record with `pg_stat_mean_ms` has the nested shape, any other the flat one. A negative or
    missing speed-up counts as 0.
    """
    nested = F.col("pg_stat_mean_ms").isNotNull()
    kind = F.coalesce("type", F.lit(EVENT))
    p_slow = F.coalesce("model.p_slow", F.lit(0.0))
    top = F.get("candidates_ranked", F.lit(0))
    saved = F.col("measured_speedup_ms")
    old_saved = F.coalesce("speedup_ms", F.lit(0.0))

    def text(new: Column, old: Column) -> Column:
        return F.coalesce(F.when(nested, new).otherwise(old), F.lit(""))

    return events.filter(kind == EVENT).select(
        F.coalesce("query", F.lit("")).alias("query"),
        F.when(nested, F.col("pg_stat_mean_ms")).otherwise(F.coalesce("avg_time_ms", F.lit(0.0))).alias("avg_time_ms"),
        F.when(nested, half_even(p_slow * 100, 1)).otherwise(F.coalesce("confidence", F.lit(0.0))).alias("confidence"),
        F.coalesce("reason", F.lit("")).alias("reason"),
        text(top["sql"], F.col("fix")).alias("fix"),
        text(top["strategy"], F.lit("")).alias("strategy"),
        F.when(nested, F.when(saved > 0, half_even(saved, 1)).otherwise(0.0)).otherwise(old_saved).alias("speedup_ms"),
        F.when(nested, F.col("top_candidate_verified").isNotNull()).otherwise(old_saved > 0).alias("measured"),
        F.when(nested, F.col("top_candidate_verified.warm_median_ms")).alias("warm_median_ms"),
        F.when(nested, p_slow >= 0.5).otherwise(F.coalesce("flagged", F.lit(False))).alias("flagged"),
        F.coalesce("timestamp", F.lit("")).alias("timestamp"),
        F.when(nested, F.coalesce("llm_source", F.lit("sqlcoder"))).otherwise("gpt").alias("llm_source"),
        kind.alias("type"),
    )


def dashboard_parts(log: DataFrame) -> DataFrame:
    """Counts and sums of a piece of the normalised log; pieces add up to the whole."""
    fixed = F.col("speedup_ms") > 0
    return log.agg(
        F.count("*").alias("total"),
        F.count_if("flagged").alias("flagged"),
        F.count_if(fixed).alias("fixed"),
        F.coalesce(F.sum(F.when(fixed, F.col("speedup_ms"))), F.lit(0.0)).alias("saved"),
    )


def dashboard_totals(parts: DataFrame) -> DataFrame:
    one = parts.agg(*[F.sum(n).alias(n) for n in ("total", "flagged", "fixed", "saved")])
    return one.select(
        "total",
        "flagged",
        "fixed",
        F.coalesce(half_even(F.try_divide("saved", "fixed"), 1), F.lit(0.0)).alias("avg_speedup"),
        half_even(F.col("saved"), 0).alias("total_saved_ms"),
    )


def dashboard_stats(log: DataFrame) -> DataFrame:
    """Totals over the normalised log, taken from its already rounded speed-ups."""
    return dashboard_totals(dashboard_parts(log))


def before_after(log: DataFrame) -> DataFrame:
    """Fixed and measured statements with bar lengths in percent of the longer of the two times."""
    before = F.col("avg_time_ms")
    after = F.coalesce("warm_median_ms", F.greatest(F.lit(0.0), before - F.col("speedup_ms")))
    longest = F.greatest(F.col("before_ms"), F.col("after_ms"), F.lit(1.0))
    return (
        log.filter((F.col("speedup_ms") > 0) & F.col("measured"))
        .select("query", before.alias("before_ms"), after.alias("after_ms"))
        .withColumns(
            {
                "before_pct": F.greatest(F.col("before_ms") / longest * 100, F.lit(3.0)),
                "after_pct": F.greatest(F.col("after_ms") / longest * 100, F.lit(3.0)),
            }
        )
    )


def speedup_pct(base: Column, new: Column) -> Column:
    return (base - new) / base * 100


def approach_summary(rows: DataFrame, approaches: Sequence[str]) -> DataFrame:
    """Mean speed-up and win rate over results that ran, broken rate over all, per approach.

    `rows` has `<approach>_speedup_pct` and `<approach>_broken` for each approach.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("approach"),
                F.col(f"{a}_speedup_pct").cast("double").alias("speedup_pct"),
                F.col(f"{a}_broken").cast("boolean").alias("broken"),
            )
            for a in approaches
        ]
    )
    ran = ~F.col("broken")
    won = F.when(ran, (F.coalesce("speedup_pct", F.lit(0.0)) > 0).cast("int"))
    return (
        rows.select(F.inline(cells))
        .groupBy("approach")
        .agg(
            F.avg(F.when(ran, F.col("speedup_pct"))).alias("avg_speedup_pct"),
            (F.avg(won) * 100).alias("win_rate_pct"),
            (F.avg(F.col("broken").cast("int")) * 100).alias("broken_rate_pct"),
        )
    )


def spot_check(rows: DataFrame) -> DataFrame:
    """Predicted label, verdict and signed error per statement (`actual_ms`, `actual_label`, `p_slow`, `predicted_ms`)."""
    guess = F.when(F.col("p_slow") > 0.5, "slow").otherwise("fast")
    return rows.withColumns(
        {
            "predicted_label": guess,
            "verdict": F.when(guess == F.col("actual_label"), "OK").otherwise("MISS"),
            "error_ms": F.col("predicted_ms") - F.col("actual_ms"),
        }
    )


def spot_check_summary(checked: DataFrame) -> DataFrame:
    log_error = F.avg(F.abs(F.log1p("actual_ms") - F.log1p("predicted_ms")))
    return checked.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("verdict") == "OK").alias("correct"),
        (F.avg((F.col("verdict") == "OK").cast("int")) * 100).alias("accuracy_pct"),
        log_error.alias("log_mae"),
        F.exp(log_error).alias("factor"),
    )


def run_result_summary(results: DataFrame) -> DataFrame:
    """Totals of one run of the monitor: wins, savings, factors, skips, and similar fixes."""
    won = F.col("result") == "win"
    skipped = F.col("result") == "skipped_below_threshold"
    saved = F.when(won, F.col("measured_speedup_ms"))
    factor = F.when(won, F.col("speedup_factor"))
    median = quantiles(results.filter(won), [], "measured_speedup_ms", {"m": 0.5})
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(won).alias("wins"),
        F.count_if(~skipped).alias("attempted"),
        F.count_if(skipped).alias("skipped"),
        (F.try_divide(F.count_if(won), F.count_if(~skipped)) * 100).alias("win_rate_pct"),
        F.sum(saved).alias("total_saved_ms"),
        F.avg(saved).alias("mean_saved_ms"),
        F.max(saved).alias("best_saved_ms"),
        F.max_by("pattern", F.when(won, F.struct("measured_speedup_ms", "pattern"))).alias("best_pattern"),
        F.avg(factor).alias("mean_factor"),
        F.max(factor).alias("best_factor"),
        (F.avg(skipped.cast("int")) * 100).alias("skip_rate_pct"),
        F.count_if("similar_fix_found").alias("similar_found"),
        F.avg(F.when(F.col("similar_fix_similarity") != 0, F.col("similar_fix_similarity"))).alias("mean_similarity"),
    ).withColumn("median_saved_ms", median.scalar())


def strategy_breakdown(results: DataFrame) -> DataFrame:
    """Wins by strategy, most frequent first."""
    return (
        results.filter(F.col("result") == "win")
        .groupBy(F.coalesce("strategy", F.lit("unknown")).alias("strategy"))
        .agg(F.count("*").alias("wins"))
        .orderBy(F.col("wins").desc(), "strategy")
    )


def generation_report(measured: DataFrame) -> DataFrame:
    return measured.agg(
        F.count_if(F.col("label") == "slow").alias("slow"),
        F.count_if(F.col("label") == "fast").alias("fast"),
        F.count("*").alias("total"),
    )


def rates(df: DataFrame, split: str, flags: dict[str, Column]) -> DataFrame:
    """Percent of rows with each flag, by split and overall, from one pass."""
    counted = df.groupBy(split).agg(F.count("*").alias("n"), *[F.count_if(f).alias(k) for k, f in flags.items()])
    both = F.explode(F.array(F.col(split), F.lit("overall")))
    return (
        counted.select(both.alias("split"), "n", *flags)
        .groupBy("split")
        .agg(F.sum("n").alias("n"), *[(F.sum(k) * 100.0 / F.sum("n")).alias(k) for k in flags])
    )


def exact_match(predicted: Column, expected: Column) -> Column:
    return F.lower(F.trim(predicted)) == F.lower(F.trim(expected))
