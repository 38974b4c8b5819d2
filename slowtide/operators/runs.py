"""Summaries of repeated executions: one row per execution in, one per statement out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions.numeric import format_runs, half_even
from slowtide.operators.ordered import join_on, quantiles

# Milliseconds that part slow from fast, stop a run, and shorten a series of runs.
SLOW_MS = 100.0
TIMEOUT_MS = 10000.0
LONG_MS, VERY_LONG_MS = 500.0, 2000.0


def warm_runs(cold: Column, timed_out: Column) -> Column:
    """How many warm runs follow a cold run of this length."""
    return F.when(timed_out | (cold > VERY_LONG_MS), 1).when(cold > LONG_MS, 2).otherwise(5)


def slow_label(warm_ms: Column, threshold: float = SLOW_MS) -> Column:
    return F.when(warm_ms > threshold, "slow").otherwise("fast")


def statement_stats(runs: DataFrame, keys: Sequence[str], ms: str) -> DataFrame:
    """Mean time and number of calls per statement."""
    return runs.groupBy(*keys).agg(F.avg(ms).alias("mean_exec_time"), F.count("*").alias("calls"))


def run_summary(
    runs: DataFrame, keys: Sequence[str], order: Sequence[str], ms: str, timeout_ms: float = TIMEOUT_MS
) -> DataFrame:
    """Cold time, warm median, warm population deviation, runs and timed-out runs per statement.

    The first run in `order` (unique) is cold; the others are warm, or the cold one if it is alone.
    Every run counts. A statement may own most runs: its first run is found by aggregation, its
    median from counted values, so its runs are never gathered.
    """
    capped = runs.select(*keys, F.struct(*order).alias("at"), F.least(F.col(ms), F.lit(float(timeout_ms))).alias("ms"))
    first = capped.groupBy(*keys).agg(F.min("at").alias("first_at"))
    marked = join_on(capped, first, keys).withColumn("is_cold", F.col("at") == F.col("first_at"))
    stats = marked.groupBy(*keys).agg(
        F.max(F.when(F.col("is_cold"), F.col("ms"))).alias("cold_ms"),
        F.stddev_pop(F.when(~F.col("is_cold"), F.col("ms"))).alias("deviation"),
        F.count("*").alias("n_runs"),
        F.count_if(F.col("ms") >= timeout_ms).alias("timed_out_runs"),
    )
    warm = quantiles(marked.filter(~F.col("is_cold")), keys, "ms", {"median": 0.5})
    return join_on(stats, warm, keys, "left").select(
        *keys,
        "cold_ms",
        F.coalesce("median", "cold_ms").alias("warm_ms"),
        F.coalesce("deviation", F.lit(0.0)).alias("warm_std_ms"),
        "n_runs",
        "timed_out_runs",
    )


def measurements(
    runs: DataFrame, keys: Sequence[str], order: Sequence[str], ms: str, timeout_ms: float = TIMEOUT_MS
) -> DataFrame:
    """The measurement protocol: the cold run, then as many warm runs as its length allows.

    At most six runs per statement take part. The row-number filter is applied before the shuffle
    too (window group limit), so a statement with very many runs sends six of them per task.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    capped = F.least(F.col(ms), F.lit(float(timeout_ms)))
    six = runs.select(*keys, *order, capped.alias("ms__")).withColumn("nth__", nth).filter("nth__ <= 6")
    series = six.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nth__", "ms__"))), lambda r: r["ms__"]).alias("runs__")
    )
    cold = F.col("runs__")[0]
    kept = series.withColumn("kept__", F.slice("runs__", F.lit(1), warm_runs(cold, cold >= timeout_ms) + 1))
    warm = kept.withColumn(
        "warm__", F.when(F.size("kept__") > 1, F.slice("kept__", 2, 5)).otherwise(F.col("kept__"))
    ).withColumn("sorted__", F.sort_array("warm__"))
    n = F.size("warm__")
    half = F.floor(n / 2).cast("int")
    middle = F.when(n % 2 == 1, F.get("sorted__", half)).otherwise(
        (F.get("sorted__", half - 1) + F.get("sorted__", half)) / 2
    )
    mean = F.aggregate("warm__", F.lit(0.0), lambda s, x: s + x) / n
    spread = warm.withColumn("mean__", mean)
    squares = F.aggregate("warm__", F.lit(0.0), lambda s, x: s + (x - F.col("mean__")) * (x - F.col("mean__")))
    return spread.select(
        *keys,
        half_even(F.col("kept__")[0], 2).alias("execution_time_cold_ms"),
        half_even(middle, 2).alias("execution_time_warm_ms"),
        half_even(F.sqrt(squares / n), 2).alias("execution_time_warm_std_ms"),
        format_runs(F.col("kept__")).alias("all_runs_ms"),
        F.size(F.filter("kept__", lambda x: x >= timeout_ms)).alias("timed_out_runs"),
        slow_label(middle).alias("label"),
    )


def slow_statements(stats: DataFrame, threshold_ms: float = SLOW_MS, n: int = 10) -> DataFrame:
    """The n slowest SELECT statements by mean time, leaving out the monitor's own statements.

    The exclusions are case-sensitive substrings, so OFFSET is excluded through SET.
    """
    return stats.filter(is_slow(threshold_ms)).orderBy(F.col("mean_exec_time").desc(), "query").limit(n)


def is_slow(threshold_ms: float = SLOW_MS) -> Column:
    """Whether a row with `mean_exec_time` and `query` is a slow statement."""
    text = F.col("query")
    own = text.contains("pg_stat_statements") | text.contains("EXPLAIN") | text.contains("SET")
    return (F.col("mean_exec_time") > threshold_ms) & ~own & F.upper(text).contains("SELECT")


def first_seen(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """The first row of each key; only one row per key and task is shuffled."""
    nth = F.row_number().over(Window.partitionBy("key__").orderBy(*order))
    return df.withColumn("key__", key).withColumn("nth__", nth).filter("nth__ = 1").drop("key__", "nth__")


def statement_key(query: Column, length: int | None = None) -> Column:
    """What identifies a statement to the monitor: its whole text, or its head if a length is given."""
    return query if length is None else F.substring(query, 1, length)
