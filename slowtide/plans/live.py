"""Streaming jobs drained over the test tables; the answer is read from what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from slowtide.functions.scorer import Scorer
from slowtide.operators import runs as R
from slowtide.plans import fixtures as X
from slowtide.plans.fixtures import Log
from slowtide.session import materialize, scratch_path
from slowtide.sources import files
from slowtide.streaming import monitor as M
from slowtide.streaming.chain import Sources, quarantined, watch

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col


def _add(name, build, sql):
    QUERIES[name] = lambda spark, folder: build(Log(spark, folder))
    CHECKS[name] = X.exact_rounding(sql)


def _stream(t):
    """The events table as a stream of executions."""
    raw = M.executions(t.spark, t.folder, t.events.schema, "events.parquet")
    return raw.select(
        "event_id", "user_id", "event_type",
        X.text_of(X.TEXTS, c("event_type"), c("user_id")).alias("query"),
        c("value").alias("ms"),
        c("ts").cast("timestamp").alias("ts"),
    )


def _drain(t, stream, each, mode="append"):
    M.start(stream, each, scratch_path(t.spark, "checkpoint"), mode, drain=True).awaitTermination()


def _poll(t):
    """Executions as each poll receives them."""
    out = scratch_path(t.spark, "polls")
    _drain(t, _stream(t), lambda rows, i: M.write_batch(rows, i, out))
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("ms"), 4).alias("ms"))


_add("t01_poll", _poll, "SELECT event_type, count(*) AS n, round(sum(value), 4) AS ms FROM events GROUP BY event_type")


def _first_seen(t):
    out = scratch_path(t.spark, "seen")
    _drain(t, _stream(t), M.keep_first_seen(out, "40 days"))
    return t.spark.read.parquet(f"{out}/new").select(c("query").alias("key"))


_add("t02_first_seen", _first_seen, f"WITH {X.SQL_STATS} SELECT DISTINCT query AS key FROM stats")


def _in_three_polls(t, rows, part, each):
    """Hand the rows to `each` in three polls of a stream, by the value of `part` (0 to 2)."""
    source, checkpoint = scratch_path(t.spark, "source"), scratch_path(t.spark, "checkpoint")
    for i in range(3):
        rows.filter(part == i).write.mode("append").parquet(source)
        M.start(M.executions(t.spark, source, rows.schema), each, checkpoint, drain=True).awaitTermination()


def _late(t):
    """Events by type in three polls, the last of which holds the early half of the time; a day of delay is allowed."""
    out = scratch_path(t.spark, "seen")
    rows = t.events.select("event_id", X.text_of(X.TEXTS, c("event_type"), c("user_id")).alias("query"), c("ts").cast("timestamp").alias("ts"))
    third = F.when(F.dayofmonth("ts") <= 15, 2).otherwise(c("event_id") % 2)
    _in_three_polls(t, rows, third, M.keep_first_seen(out, "1 day", buckets=8))
    new, late = (t.spark.read.parquet(f"{out}/{name}").select("event_id", F.lit(name).alias("outcome")) for name in ("new", "late"))
    return new.union(late)


_add(
    "t02_late_rows",
    _late,
    f"""WITH polled AS (SELECT event_id, {X.sql_text_of(X.TEXTS, "event_type", "user_id")} AS query, ts, CASE WHEN day(ts) <= 15 THEN 2 ELSE event_id % 2 END AS poll FROM events),
       clocks AS (SELECT poll, lag(latest) OVER (ORDER BY poll) AS clock FROM (
         SELECT p.poll, max(q.ts) AS latest FROM (SELECT DISTINCT poll FROM polled) p JOIN polled q ON q.poll <= p.poll GROUP BY p.poll)),
       told AS (SELECT p.*, clock, coalesce(ts < clock - INTERVAL 1 DAY, FALSE) AS late FROM polled p JOIN clocks USING (poll)),
       firsts AS (SELECT poll, query, arg_min(event_id, {{'ts': ts, 'event_id': event_id}}) AS event_id, max(ts) AS last, any_value(clock) AS clock FROM told WHERE NOT late GROUP BY poll, query)
       SELECT event_id, 'late' AS outcome FROM told WHERE late
       UNION ALL SELECT event_id, 'new' FROM firsts f WHERE NOT EXISTS (
         SELECT 1 FROM firsts e WHERE e.poll < f.poll AND e.query = f.query AND e.last >= f.clock - INTERVAL 1 DAY)""",
)


def _last(t, path):
    """The rows of the last poll."""
    polls = t.spark.read.parquet(path)
    return polls.filter(c("batch_id") == polls.agg(F.max("batch_id")).scalar())


def _top(t):
    out = scratch_path(t.spark, "top")
    _drain(t, _stream(t), M.keep_top(out, X.DETECT_MS))
    return _last(t, f"{out}/top").select("query", F.round("mean_exec_time", 6).alias("mean_exec_time"), "calls")


_TOP_SQL = f"""WITH {X.SQL_STATS} SELECT query, round(mean_exec_time, 6) AS mean_exec_time, calls FROM stats
       WHERE mean_exec_time > 50 AND NOT contains(query, 'SET') ORDER BY stats.mean_exec_time DESC, query LIMIT 10"""
_add("t03_top_of_poll", _top, _TOP_SQL)


def _top_of_polls(t):
    """The same ranking, from three polls that share statements; the sums are merged after the second."""
    out = scratch_path(t.spark, "top")
    rows = t.events.select("event_id", X.text_of(X.TEXTS, c("event_type"), c("user_id")).alias("query"), c("value").alias("ms"))
    _in_three_polls(t, rows, c("event_id") % 3, M.keep_top(out, X.DETECT_MS, merge_every=2))
    return _last(t, f"{out}/top").select("query", F.round("mean_exec_time", 6).alias("mean_exec_time"), "calls")


_add("t03_top_of_three_polls", _top_of_polls, _TOP_SQL)


def _vector_history(t, rows):
    path = scratch_path(t.spark, "history")
    M.write_batch(
        rows.select(c("vec_id").alias("entry_id"), F.lit("q").alias("slow_query"), F.lit("f").alias("fix"), F.lit(1.0).alias("speedup_ms"), c("embedding").alias("vector")),
        -1,
        path,
    )
    return path


def _sources(t):
    def answers(statements):
        parts = F.split("stmt", ":")
        return t.answers_to(statements.withColumns({"user_id": parts[0].cast("bigint"), "event_type": parts[1]}))

    return Sources(answers, t.planned, t.measured_of, "sqlcoder_finetuned")


def _loaded_scorer(t):
    path = scratch_path(t.spark, "scorer")
    X.SCORER.save(t.spark, path)
    return Scorer.load(t.spark, path)


def _statements(t, executions):
    """The statements of a poll of executions, with the plan and the vector that belong to their user."""
    stats = R.statement_stats(executions, X.KEYS, "ms")
    named = stats.withColumns(
        {
            "stmt": F.concat_ws(":", c("user_id").cast("string"), "event_type"),
            "query": X.text_of(X.TEXTS, c("event_type"), c("user_id")),
            "plan": X.statement_plan(c("calls"), c("user_id")),
            "timestamp": F.lit("2024-01-31T00:00:00"),
        }
    )
    vectors = t.embeddings.select(c("vec_id").alias("user_id"), c("embedding").alias("vector"))
    return named.join(vectors, "user_id", "left")


def _watched(t):
    """The whole chain over the executions; the past fixes are the vectors with odd ids."""
    out = scratch_path(t.spark, "watched")
    each = watch(out, _vector_history(t, t.embeddings.filter("vec_id % 2 = 1")), _loaded_scorer(t), _sources(t), threshold=0.4)
    _drain(t, _stream(t), lambda rows, i: each(_statements(t, rows), i))
    entries = t.spark.read.parquet(f"{out}/handled").select("stmt", "entry_id")
    return t.spark.read.parquet(f"{out}/events").join(entries, "stmt").select(
        "stmt", "type", "query", "pg_stat_mean_ms", "calls", F.coalesce("model.p_slow", F.round("p_slow", 4)).alias("p_slow"),
        F.coalesce(F.array_size("candidates_ranked"), F.lit(0)).cast("bigint").alias("n_candidates"), F.get("candidates_ranked", F.lit(0))["sql"].alias("top_sql"),
        "reason", c("top_candidate_verified.warm_median_ms").alias("warm_median_ms"), "measured_speedup_ms", "entry_id", "similar_fix_used",
    )


SQL_SIMILAR = """pairs AS (
  SELECT a.vec_id AS lookup_id, b.vec_id AS entry_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
           / sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
           / sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY lookup_id ORDER BY similarity DESC, entry_id) AS rank FROM pairs WHERE similarity > 0.4)"""
# an odd id finds itself
_ENTRY_SQL = """entries AS (SELECT vec_id AS user_id, CASE WHEN vec_id % 2 = 1 THEN vec_id ELSE (
         SELECT min_by(entry_id, {'s': -similarity, 'e': entry_id}) FROM pairs WHERE lookup_id = vec_id AND entry_id % 2 = 1 AND similarity > 0.4) END AS entry_id FROM embeddings)"""
_add(
    "t04_enrich",
    _watched,
    f"""WITH {X.SQL_EVENTS}, {SQL_SIMILAR}, {_ENTRY_SQL}
       SELECT stmt, 'slow_query_handled' AS type, query, round_even(mean_exec_time, 2) AS pg_stat_mean_ms, calls, round(p_slow, 4) AS p_slow,
         n AS n_candidates, top_sql, 'Query optimization strategies: ' || names AS reason, verified_warm_ms AS warm_median_ms,
         round_even(measured_speedup_ms, 2) AS measured_speedup_ms, entry_id, entry_id IS NOT NULL AS similar_fix_used
       FROM flat LEFT JOIN entries ON entries.user_id = CAST(split_part(stmt, ':', 1) AS BIGINT)""",
)


def _damaged(t):
    """Statements in three polls. The second one holds cut-off plans, missing texts and times below zero."""
    out = scratch_path(t.spark, "watched")
    stats = _statements(t, t.events.withColumnRenamed("value", "ms"))
    second = c("user_id") % 3 == 1
    rows = stats.withColumns(
        {
            "plan": F.when(second & (c("calls") % 3 == 0), '{"Plan": {"Node Type": "Seq').otherwise(c("plan")),
            "query": F.when(second & (c("event_type") == "view"), None).otherwise(c("query")),
            "mean_exec_time": F.when(second & (c("event_type") == "signup"), -1.0).otherwise(c("mean_exec_time")),
        }
    )
    each = watch(out, _vector_history(t, t.embeddings), _loaded_scorer(t), _sources(t))
    # each poll takes its share of them
    _in_three_polls(t, materialize(rows, "statements"), c("user_id") % 3, each)
    handled = t.spark.read.parquet(f"{out}/events").select("stmt", c("type").alias("outcome"), c("batch_id").cast("bigint").alias("poll"))
    return handled.unionByName(quarantined(t.spark, out).select("stmt", c("stage").alias("outcome"), c("batch_id").alias("poll")))


_add(
    "t06_quarantine",
    _damaged,
    f"""WITH {X.SQL_SCORED} SELECT stmt, poll, CASE WHEN poll = 1 AND event_type IN ('view', 'signup') THEN 'statement' WHEN poll = 1 AND calls % 3 = 0 THEN 'plan'
         ELSE 'slow_query_handled' END AS outcome
       FROM (SELECT *, user_id % 3 AS poll FROM scored) WHERE p_slow >= 0.5 OR poll = 1 AND (event_type IN ('view', 'signup') OR calls % 3 = 0)""",
)


def _repeated(t):
    """Each poll is written twice, as after a failure between write and commit."""
    out = scratch_path(t.spark, "events")

    def each(rows, batch_id):
        M.write_batch(rows, batch_id, out)
        M.write_batch(rows, batch_id, out)

    _drain(t, _stream(t), each)
    return t.spark.read.parquet(out).select("event_id", "query", "ms")


_add(
    "t05_append_once",
    _repeated,
    f"SELECT event_id, {X.sql_text_of(X.TEXTS, 'event_type', 'user_id')} AS query, value AS ms FROM events",
)


def _running_means(t):
    """Each poll writes sums and calls; the parts are compacted once and then added up."""
    out, merged = scratch_path(t.spark, "means"), scratch_path(t.spark, "merged")
    _drain(t, _stream(t), M.keep_parts(out, M.mean_parts))
    M.compact(t.spark, out, ["query"], merged)
    return M.running_means(t.spark, merged).select("query", F.round("mean_exec_time", 6).alias("mean_exec_time"), "calls")


_add(
    "t07_running_means",
    _running_means,
    f"WITH {X.SQL_STATS} SELECT query, round(mean_exec_time, 6) AS mean_exec_time, calls FROM stats",
)


def _windows(t):
    """Hourly counts of all hours, the open ones and late rows included."""
    out = scratch_path(t.spark, "windows")
    _drain(t, _stream(t), M.keep_parts(out, lambda rows: M.window_parts(rows, "1 hour", 100.0)))
    return M.slow_windows(t.spark, out).select(c("start").cast("timestamp_ntz").alias("start"), "n", "slow")


_add(
    "t08_slow_windows",
    _windows,
    "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, count(*) AS n, count(*) FILTER (value > 100) AS slow FROM events GROUP BY ALL",
)


def _dashboard(t):
    """Old-shape records from the events stream; the dashboard adds up the polls."""
    log, parts = scratch_path(t.spark, "log"), scratch_path(t.spark, "parts")
    known = t.spark.createDataFrame([], files.EVENT)
    stream = _stream(t).select(
        "query", c("ms").alias("avg_time_ms"), (c("ms") - 50).alias("speedup_ms"), (c("ms") > 100).alias("flagged")
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema if f.name not in stream.columns]
    _drain(t, stream.select("*", *missing), M.refresh(log, parts))
    return M.dashboard(t.spark, parts)


_add(
    "t09_dashboard",
    _dashboard,
    """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (value > 100) AS BIGINT) AS flagged,
         CAST(count(*) FILTER (value > 50) AS BIGINT) AS fixed, round_even(avg(value - 50) FILTER (value > 50), 1) AS avg_speedup,
         round_even(sum(value - 50) FILTER (value > 50), 0) AS total_saved_ms FROM events""",
)
