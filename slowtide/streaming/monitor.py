"""The monitor as Structured Streaming jobs over executions.

Executions are rows with `query`, `ms` and an event time `ts`. A restart continues from the checkpoint.
No job keeps state in the stream: each poll writes what it adds, and `compact` merges the parts. First-seen keys
and the sums behind the ranking of each poll lie in files by bucket, of which a poll reads those it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slowtide.operators.reports import dashboard_parts, dashboard_totals, normalise_log
from slowtide.operators.runs import is_slow, slow_statements, statement_key
from slowtide.sources.files import exists

# Fixed value: seconds between two polls.
POLL_SECONDS = 5


def executions(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_poll: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_poll:
        reader = reader.option("maxFilesPerTrigger", files_per_poll)
    return reader.parquet(folder)


def start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    drain: bool = False,
) -> StreamingQuery:
    """Hand each poll's rows to `each`; every five seconds, or once through all input if `drain`."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{POLL_SECONDS} seconds").start()


BUCKETS = 16


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _earlier(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """Rows that polls before this one wrote below `path`; none before the first."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path).filter(F.col("batch_id") < batch_id)


def keep_first_seen(path: str, horizon: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Per poll: write the executions whose key was not met within `horizon` of event time before (`path`/new), and set
    aside those that are later than the horizon (`path`/late), which cannot be judged any more.

    The keys that were met lie in a table in buckets of their hash. A poll reads the buckets it touches and of these the
    polls that are within the horizon; nothing is kept in the stream's state, and a repeated poll replaces its own rows.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        keyed = rows.withColumn("key", statement_key(F.col("query")))
        # one row per poll
        clock = _earlier(spark, f"{path}/clock", "latest timestamp", batch_id).agg(F.max("latest").alias("clock"))
        reach = clock.select((F.col("clock") - F.expr(f"INTERVAL {horizon}")).alias("since")).scalar()
        write_batch(rows.agg(F.max("ts").alias("latest")), batch_id, f"{path}/clock")
        told = keyed.withColumn("since", reach).withColumn("on_time", F.col("ts").isNotNull() & (F.col("since").isNull() | (F.col("ts") >= F.col("since"))))
        write_batch(told.filter(~F.col("on_time")).drop("key", "since", "on_time"), batch_id, f"{path}/late")
        held = F.struct(*rows.columns)
        met = told.filter("on_time").groupBy("key").agg(F.min_by(held, F.struct("ts", *[c for c in rows.columns if c != "ts"])).alias("first"), F.max("ts").alias("last"))
        met = met.withColumn("bucket", _bucket("key", buckets))
        write_batch(met.select("key", "last", "bucket", "first"), batch_id, f"{path}/met")
        mine = spark.read.schema(met.select("key", "last", "bucket", "first").schema).parquet(f"{path}/met/batch_id={batch_id}")
        touched = [r["bucket"] for r in mine.select("bucket").distinct().collect()]  # at most `buckets`
        known = _earlier(spark, f"{path}/seen", "key string, last timestamp, bucket int", batch_id).filter(F.col("bucket").isin(touched)).withColumn("since", reach)
        known = known.filter(F.col("since").isNull() | (F.col("last") >= F.col("since"))).select(F.col("key").alias("known_key")).distinct()
        new = mine.join(known, F.col("key").eqNullSafe(F.col("known_key")), "left_anti")
        write_batch(new.select("first.*"), batch_id, f"{path}/new")
        mine.select("key", "last", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/seen/batch_id={batch_id}")

    return each


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write one poll's rows in its own partition folder; a repeated poll replaces, never doubles, them."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def window_parts(rows: DataFrame, width: str, threshold_ms: float) -> DataFrame:
    """Executions and slow executions per window, of the rows of one poll."""
    grouped = rows.groupBy(F.window("ts", width).alias("w"))
    return grouped.agg(F.count("*").alias("n"), F.count_if(F.col("ms") > threshold_ms).alias("slow")).select(F.col("w.start").alias("start"), "n", "slow")


def mean_parts(rows: DataFrame) -> DataFrame:
    """Sum of times and calls per statement text, of the rows of one poll."""
    return rows.groupBy("query").agg(F.sum("ms").alias("ms"), F.count("ms").alias("timed"), F.count("*").alias("calls"))


def keep_parts(path: str, part: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Per poll: write what its rows add. The stream itself keeps no state, and a late row counts as any other."""

    def each(rows: DataFrame, batch_id: int) -> None:
        write_batch(part(rows), batch_id, path)

    return each


def slow_windows(spark: SparkSession, path: str) -> DataFrame:
    """All windows met so far, open ones included, from the parts of the polls."""
    return spark.read.parquet(path).groupBy("start").agg(F.sum("n").alias("n"), F.sum("slow").alias("slow"))


def running_means(spark: SparkSession, path: str) -> DataFrame:
    """Mean time and calls of every statement so far, from the parts of the polls."""
    sums = spark.read.parquet(path).groupBy("query").agg(F.sum("ms").alias("ms"), F.sum("timed").alias("timed"), F.sum("calls").alias("calls"))
    return sums.select("query", F.try_divide("ms", "timed").alias("mean_exec_time"), "calls")


def compact(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """Write the parts below `path` as one part per key below `target`, for a job that goes on there."""
    parts = spark.read.parquet(path)
    sums = [F.sum(c).alias(c) for c in parts.columns if c not in (*keys, "batch_id")]
    write_batch(parts.groupBy(*keys).agg(*sums), -1, target)


def keep_top(path: str, threshold_ms: float, n: int = 10, buckets: int = BUCKETS, merge_every: int = 16) -> Callable[[DataFrame, int], None]:
    """Per poll: the n slowest statements so far by mean time (`path`/top).

    Sums and calls per statement are kept as files in buckets of the statement's hash, merged every `merge_every` polls.
    A poll adds up the buckets it touches and of each retains the n slowest statements; those of the other buckets are
    taken over from the poll before. So a poll ranks at most `buckets` * n statements, the stream itself keeps no state,
    late rows count, and a repeated poll replaces what it wrote.
    """
    sums, best = "query string, ms double, timed bigint, calls bigint, bucket int", "bucket int, best array<struct<query:string,mean_exec_time:double,calls:bigint>>"

    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        part = mean_parts(rows).withColumn("bucket", _bucket("query", buckets))
        part.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/sums/batch_id={batch_id}")
        touched = [r["bucket"] for r in spark.read.schema(sums).parquet(f"{path}/sums/batch_id={batch_id}").select("bucket").distinct().collect()]  # at most `buckets`
        merged = _earlier(spark, f"{path}/merged", sums, batch_id)
        done = merged.agg(F.max("batch_id")).first()[0]
        done = -1 if done is None else done
        since = _earlier(spark, f"{path}/sums", sums, batch_id + 1).filter(F.col("batch_id") > done)
        parts = merged.filter(F.col("batch_id") == done).unionByName(since)
        total = lambda some: some.groupBy("bucket", "query").agg(F.sum("ms").alias("ms"), F.sum("timed").alias("timed"), F.sum("calls").alias("calls"))
        means = total(parts.filter(F.col("bucket").isin(touched))).select("bucket", "query", F.try_divide("ms", "timed").alias("mean_exec_time"), "calls")
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("mean_exec_time").desc(), "query"))
        slowest = means.filter(is_slow(threshold_ms)).withColumn("nth", nth).filter(F.col("nth") <= n)
        listed = slowest.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("nth", "query", "mean_exec_time", "calls"))).alias("s"))
        fresh = listed.select("bucket", F.transform("s", lambda x: F.struct(x["query"].alias("query"), x["mean_exec_time"].alias("mean_exec_time"), x["calls"].alias("calls"))).alias("best"))
        last = _earlier(spark, f"{path}/best", best, batch_id).filter(F.col("batch_id") == batch_id - 1).drop("batch_id")
        write_batch(fresh.unionByName(last.filter(~F.col("bucket").isin(touched))), batch_id, f"{path}/best")
        kept = spark.read.schema(best).parquet(f"{path}/best/batch_id={batch_id}").select(F.inline("best"))
        write_batch(slow_statements(kept, threshold_ms, n), batch_id, f"{path}/top")
        if batch_id % merge_every == merge_every - 1:
            total(parts).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/merged/batch_id={batch_id}")

    return each


def refresh(log_path: str, parts_path: str) -> Callable[[DataFrame, int], None]:
    """Per poll: append the new events and the counts and sums they add to the dashboard.

    The dashboard adds up one row per poll instead of reading the log again.
    """

    def each(events: DataFrame, batch_id: int) -> None:
        write_batch(events, batch_id, log_path)
        write_batch(dashboard_parts(normalise_log(events)), batch_id, parts_path)

    return each


def dashboard(spark: SparkSession, parts_path: str) -> DataFrame:
    return dashboard_totals(spark.read.parquet(parts_path))
