"""Query-log frames derived from the test tables, and the same frames as SQL for the checks.

An event is one execution of the statement (user_id, event_type); its value is the time in ms.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions.plantree import PLAN_FEATURES, plan_features
from slowtide.functions.numeric import half_even, parse_runs
from slowtide.functions.scorer import FEATURES, Scorer
from slowtide.functions.text import text_features
from slowtide.operators import candidates as C
from slowtide.operators import runs as R
from slowtide.plans.stack import Stack
from slowtide.session import materialize

# thresholds that suit the values in the test events
LABEL_MS, DETECT_MS, TIMEOUT_MS = 35.0, 50.0, 300.0
KEYS = ["user_id", "event_type"]

TEXTS = {
    "click": "SELECT * FROM users WHERE LOWER(display_name) = 'u{u}' OR id = $1",
    "error": "select p.id, count(*) from posts p join users u on p.owner_user_id = u.id join votes v on v.post_id = p.id where u.id = {u} group by p.id order by p.id",
    "purchase": "SELECT display_name, (SELECT COUNT(*) FROM posts WHERE owner_user_id = users.id) AS n FROM users WHERE id = {u}",
    "signup": "SELECT * FROM posts WHERE title LIKE '%{u}%' ORDER BY score DESC LIMIT 10 OFFSET 0",
    "view": "SELECT id FROM posts WHERE score > {u} UNION SELECT id FROM users WHERE id = $12",
}
ANSWERS = {
    "click": "SELECT id, display_name FROM users WHERE id = {u} LIMIT 1;\nThis reads one row.",
    "error": "WITH c AS (SELECT 1 AS one) SELECT one FROM c;",
    "purchase": "SELECT u.display_name, COUNT(p.id) FROM users u\nLEFT JOINS posts p ON p.owner_user_id = u.id WHERE u.id = {u} GROUP BY u.display_name\nOFFSET 0 ROWS;",
    "signup": "SELECT id FROM posts WHERE score > {u} LIMIT 10;;",
    "view": "SELECT id FROM posts WHERE score > {u} LIMIT 10",
}
# the answers after extraction and cleaning; "error" is invalid, "view" repeats "signup"
CLEAN = {
    "click": "SELECT id, display_name FROM users WHERE id = {u} LIMIT 1",
    "purchase": "SELECT u.display_name, COUNT(p.id) FROM users u\nLEFT JOIN posts p ON p.owner_user_id = u.id WHERE u.id = {u} GROUP BY u.display_name",
    "signup": "SELECT id FROM posts WHERE score > {u} LIMIT 10",
}
TYPES = list(TEXTS)


def _weights(**named: float) -> list[float]:
    return [named.get(f, 0.0) for f in FEATURES]


SCORER = Scorer(
    features=FEATURES,
    means=_weights(plan_total_cost=100.0),
    scales=[50.0 if f == "plan_total_cost" else 1.0 for f in FEATURES],
    slow_weights=_weights(has_select_star=0.8, join_count=0.5, has_subquery=1.0, plan_total_cost=0.9),
    slow_bias=-0.5,
    log_weights=_weights(join_count=0.4, has_subquery=0.5, has_function_in_where=0.3, plan_total_cost=0.2),
    log_bias=3.0,
)


def text_of(texts: dict[str, str], kind: Column, user: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, template in texts.items():
        out = F.when(kind == k, F.replace(F.lit(template), F.lit("{u}"), user.cast("string"))).otherwise(out)
    return out


def sql_text_of(texts: dict[str, str], kind: str, user: str) -> str:
    cases = " ".join(
        f"WHEN '{k}' THEN replace('{t.replace(chr(39), chr(39) * 2)}', '{{u}}', CAST({user} AS VARCHAR))" for k, t in texts.items()
    )
    return f"CASE {kind} {cases} END"


def statement_plan(calls: Column, user: Column) -> Column:
    return F.format_string(
        '{"Plan": {"Node Type": "Hash Join", "Total Cost": %d.0, "Plan Rows": %d, "Actual Rows": %d, "Plans": ['
        '{"Node Type": "Seq Scan", "Shared Hit Blocks": %d}, {"Node Type": "Index Scan", "Shared Read Blocks": %d}]}}',
        calls * 10, calls, user, user, calls,
    )


class Log(Stack):
    @cached_property
    def stats(self) -> DataFrame:
        """Mean time, calls, text and key of every statement."""
        grouped = R.statement_stats(self.events, KEYS, "value")
        return grouped.withColumns(
            {
                "query": text_of(TEXTS, F.col("event_type"), F.col("user_id")),
                "stmt": F.concat_ws(":", F.col("user_id").cast("string"), "event_type"),
            }
        )

    @cached_property
    def featured(self) -> DataFrame:
        plan = plan_features(statement_plan(F.col("calls"), F.col("user_id")))
        rows = self.stats.withColumns(text_features(F.col("query"))).withColumn("plan", plan)
        # features are a stored table: a filter on a score would otherwise be pushed below them and
        # evaluate every plan again for each feature it reads
        return materialize(rows.select("*", "plan.*").drop("plan"), "features")

    @cached_property
    def scored(self) -> DataFrame:
        return self.featured.withColumns({"p_slow": SCORER.p_slow(), "predicted_ms": SCORER.predicted_ms()})

    @cached_property
    def answers(self) -> DataFrame:
        return self.answers_to(self.stats)

    def answers_to(self, statements: DataFrame) -> DataFrame:
        """One generated answer per statement for each other event type, in order of the types."""
        others = F.filter(F.array(*[F.lit(k) for k in TYPES]), lambda k: k != F.col("event_type"))
        each = statements.select("stmt", "query", "user_id", "mean_exec_time", F.posexplode(others).alias("position", "other"))
        raw = F.concat(
            F.lit("### Slow Query\n"), F.col("query"), F.lit("\n### Optimized Query\n```sql\n"),
            text_of(ANSWERS, F.col("other"), F.col("user_id")), F.lit("\n```"),
        )
        return each.withColumn("raw", raw)

    @cached_property
    def candidates(self) -> DataFrame:
        return C.extract_candidates(self.answers, "stmt", "position")

    @staticmethod
    def planned(candidates: DataFrame) -> DataFrame:
        """Candidates with the features of their plans."""
        plan = {f: F.lit(0) for f in PLAN_FEATURES}
        return candidates.withColumns(plan | {"plan_total_cost": (F.col("position") * 25).cast("double")})

    @cached_property
    def ranked(self) -> DataFrame:
        scored = self.planned(self.candidates).withColumns(text_features(F.col("sql"))).withColumn(
            "predicted_ms", SCORER.predicted_ms()
        )
        ranked = C.rank_candidates(scored.drop(*FEATURES), "stmt", "position", "mean_exec_time")
        # read by the verification, the lists and the labels of the events
        return materialize(ranked, "ranked")

    @cached_property
    def summaries(self) -> DataFrame:
        return R.run_summary(self.events, KEYS, ["ts", "event_id"], "value", TIMEOUT_MS)

    @cached_property
    def measured(self) -> DataFrame:
        return self.measured_of(self.ranked)

    def measured_of(self, ranked: DataFrame) -> DataFrame:
        """Each statement's candidates with the summary of the runs that stand for their text."""
        return ranked.select("stmt", "sql").join(self.runs, "sql")

    @cached_property
    def runs(self) -> DataFrame:
        """Summaries and series of the runs that stand for a candidate's text."""
        runs = self.summaries.join(self.protocol.select(*KEYS, parse_runs(F.col("all_runs_ms")).alias("all_runs_ms")), KEYS)
        named = runs.withColumn("sql", text_of(CLEAN, F.col("event_type"), F.col("user_id"))).filter("sql IS NOT NULL")
        # every poll of a stream asks for them
        return materialize(named.select("sql", "cold_ms", "warm_ms", "all_runs_ms"), "runs")

    @cached_property
    def verified(self) -> DataFrame:
        return C.verify(self.ranked, self.measured, "stmt", "mean_exec_time")

    @cached_property
    def handled(self) -> DataFrame:
        return C.gate(self.scored).withColumns(
            {"similar_fix_used": F.col("calls") > 12, "timestamp": F.lit("2024-01-31T00:00:00")}
        )

    @cached_property
    def assembled(self) -> DataFrame:
        gated = self.handled.select("stmt")
        # statements on clicks get no answers, so that both kinds of event occur
        ranked = self.ranked.filter(~F.col("stmt").endswith(":click")).join(gated, "stmt", "left_semi")
        verified = self.verified.filter(~F.col("stmt").endswith(":click"))
        return C.assemble_events(self.handled, ranked, verified, "stmt", "position", "sqlcoder_finetuned")

    @cached_property
    def log(self) -> DataFrame:
        """New records of the gated statements and old-shape records of the others."""
        old = self.scored.filter(F.col("p_slow") < C.P_SLOW_GATE).select(
            "query",
            F.col("mean_exec_time").alias("avg_time_ms"),
            F.bround(F.col("p_slow") * 100, 1).alias("confidence"),
            F.lit("old record").alias("reason"),
            F.lit("CREATE INDEX").alias("fix"),
            F.when(F.col("calls") % 2 == 0, F.bround(F.col("mean_exec_time") - 45, 1)).alias("speedup_ms"),
            (F.col("mean_exec_time") > 50).alias("flagged"),
            F.lit("2023-12-31T00:00:00").alias("timestamp"),
        )
        return self.assembled.unionByName(old, allowMissingColumns=True)

    @cached_property
    def protocol(self) -> DataFrame:
        """The measurement protocol over the events (one cold and up to five warm runs), with the test data's threshold."""
        rows = R.measurements(self.events, KEYS, ["ts", "event_id"], "value", TIMEOUT_MS)
        return rows.withColumn("label", R.slow_label(F.col("execution_time_warm_ms"), LABEL_MS))

    @cached_property
    def measurements(self) -> DataFrame:
        """The measurement table: times, time-outs and label from all recorded runs; the series is the protocol's."""
        series = self.protocol.select(*KEYS, "all_runs_ms")
        rows = self.summaries.join(series, KEYS).select(
            *KEYS,
            half_even(F.col("cold_ms"), 2).alias("execution_time_cold_ms"),
            half_even(F.col("warm_ms"), 2).alias("execution_time_warm_ms"),
            half_even(F.col("warm_std_ms"), 2).alias("execution_time_warm_std_ms"),
            "all_runs_ms",
            F.col("timed_out_runs").cast("int").alias("timed_out_runs"),
            R.slow_label(F.col("warm_ms"), LABEL_MS).alias("label"),
        )
        return rows.withColumn("query_text", text_of(TEXTS, F.col("event_type"), F.col("user_id")))

    @cached_property
    def training(self) -> DataFrame:
        """Measurements with all twenty features."""
        return self.measurements.join(self.featured.drop("query", "mean_exec_time"), KEYS)

    @cached_property
    def pairs(self) -> DataFrame:
        """A user turn and the assistant turn that follows it."""
        turns = self.conversations
        asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("slow"))
        said = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("optimized"))
        return asked.join(said, ["conv_id", "turn"]).select(
            F.concat_ws("-", "conv_id", "turn").alias("pair_id"), "conv_id", "turn", "slow", "optimized"
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Every lineitem as one scored query: true and predicted times, label and probability."""
        true_ms = F.col("l_extendedprice") / 100
        logit = (F.col("l_quantity") - 25) / 5
        predicted_log = F.ln(F.col("l_quantity") * 20 + 50)
        return self.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
            true_ms.alias("true_ms"),
            F.log1p(true_ms).alias("true_log"),
            (F.col("l_extendedprice") > 60000).cast("int").alias("actual"),
            logit.alias("logit"),
            (1 / (1 + F.exp(-logit))).alias("p_slow"),
            (F.col("l_quantity") > 25).cast("int").alias("predicted"),
            predicted_log.alias("predicted_log"),
            F.col("l_returnflag").alias("fold"),
        )


# ---- the same frames as SQL


def exact_rounding(sql: str) -> str:
    """round_even(x, n) written as printf, which rounds the exact binary value as half_even does."""
    mark = "round_even("
    while mark in sql:
        start = sql.rindex(mark)
        depth, at = 1, start + len(mark)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            at += 1
        value, digits = sql[start + len(mark) : at - 1].rsplit(",", 1)
        sql = f"{sql[:start]}(CAST(printf('%.{digits.strip()}f', {value}) AS DOUBLE) + 0.0){sql[at:]}"
    return sql


SQL_STATS = f"""stats AS (
  SELECT user_id, event_type, avg(value) AS mean_exec_time, count(*) AS calls,
         {sql_text_of(TEXTS, "event_type", "user_id")} AS query,
         user_id || ':' || event_type AS stmt
  FROM events GROUP BY user_id, event_type)"""


def sql_count(text: str, piece: str) -> str:
    return f"CAST((length({text}) - length(replace({text}, '{piece}', ''))) / {len(piece)} AS INTEGER)"


def sql_features(query: str) -> str:
    up = f"upper({query})"
    return f"""CAST(contains({up}, 'SELECT *') AS INTEGER) AS has_select_star,
         CAST(contains({up}, 'LIKE ''%') AS INTEGER) AS has_like_wildcard,
         {sql_count(up, 'JOIN')} AS join_count,
         CAST({sql_count(up, 'SELECT')} > 1 AS INTEGER) AS has_subquery,
         CAST(contains({up}, 'GROUP BY') AS INTEGER) AS has_group_by,
         CAST(contains({up}, 'ORDER BY') AND NOT contains({up}, 'LIMIT') AS INTEGER) AS has_order_by_no_limit,
         CAST(contains({up}, ' OR ') AS INTEGER) AS has_or,
         CAST(regexp_matches({up}, '(LOWER|UPPER|EXTRACT|LENGTH)\\(') AS INTEGER) AS has_function_in_where"""


SQL_SCORED = SQL_STATS + f""", featured AS (SELECT *, calls * 10.0 AS plan_total_cost, {sql_features("query")} FROM stats),
scored AS (
  SELECT *, 1 / (1 + exp(-(-0.5 + 0.8 * has_select_star + 0.5 * join_count + has_subquery + 0.9 * (plan_total_cost - 100) / 50))) AS p_slow,
         exp(least(9.21, greatest(-1, 3 + 0.4 * join_count + 0.5 * has_subquery + 0.3 * has_function_in_where
           + 0.2 * (plan_total_cost - 100) / 50))) - 1 AS predicted_ms
  FROM featured)"""

_ORDER = "CASE t WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
SQL_CANDIDATES = SQL_SCORED + f""", others AS (
  SELECT stmt, query, user_id, mean_exec_time, t,
         row_number() OVER (PARTITION BY stmt ORDER BY {_ORDER}) - 1 AS position
  FROM stats, (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS t) WHERE t <> event_type),
texts AS (
  SELECT *, {sql_text_of({**CLEAN, "view": CLEAN["signup"]}, "t", "user_id")} AS sql FROM others),
candidates AS (
  SELECT stmt, query, mean_exec_time, sql, min(position) AS position FROM texts WHERE sql IS NOT NULL
  GROUP BY stmt, query, mean_exec_time, sql)"""

SQL_RANKED = SQL_CANDIDATES + f""", candidate_features AS (SELECT *, {sql_features("sql")} FROM candidates),
labelled AS (
  SELECT *, CASE WHEN contains(upper(query), 'SELECT *') THEN 'remove SELECT *'
                 WHEN {sql_count("upper(query)", "SELECT")} > 1 THEN 'rewrite subquery as JOIN'
                 WHEN join_count < {sql_count("upper(query)", "JOIN")} THEN 'reduce JOINs'
                 WHEN contains(sql, 'WHERE') AND NOT contains(upper(query), 'WHERE') THEN 'add WHERE filter'
                 WHEN contains(sql, 'LIMIT') AND NOT contains(upper(query), 'LIMIT') THEN 'add LIMIT'
                 ELSE 'rewrite query' END AS strategy,
         exp(least(9.21, greatest(-1, 3 + 0.4 * join_count + 0.5 * has_subquery + 0.3 * has_function_in_where
           + 0.2 * (position * 25.0 - 100) / 50))) - 1 AS predicted_ms
  FROM candidate_features),
ranked AS (
  SELECT *, mean_exec_time - predicted_ms AS predicted_speedup_ms,
         row_number() OVER (PARTITION BY stmt ORDER BY mean_exec_time - predicted_ms DESC, position) AS rank FROM labelled)"""

SQL_SUMMARY = """runs AS (
  SELECT user_id, event_type, least(value, 300.0) AS ms,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events),
summaries AS (
  SELECT user_id, event_type, max(ms) FILTER (nth = 1) AS cold_ms,
         coalesce(median(ms) FILTER (nth > 1), max(ms) FILTER (nth = 1)) AS warm_ms,
         coalesce(stddev_pop(ms) FILTER (nth > 1), 0.0) AS warm_std_ms,
         count(*) AS n_runs, count(*) FILTER (ms >= 300) AS timed_out_runs
  FROM runs GROUP BY user_id, event_type)"""

SQL_VERIFIED = SQL_RANKED + ", " + SQL_SUMMARY + f""", measured AS (
  SELECT {sql_text_of(CLEAN, "event_type", "user_id")} AS sql, round_even(cold_ms, 1) AS cold, round_even(warm_ms, 1) AS warm
  FROM summaries),
verified AS (
  SELECT r.*, m.cold AS verified_cold_ms, m.warm AS verified_warm_ms, r.mean_exec_time - m.warm AS measured_speedup_ms
  FROM ranked r LEFT JOIN measured m ON m.sql = r.sql AND r.predicted_speedup_ms > 0 WHERE r.rank = 1)"""

SQL_EVENTS = SQL_VERIFIED + """, lists AS (
  SELECT stmt, count(*) AS n, string_agg(strategy, ', ' ORDER BY position) AS names,
         min_by(sql, rank) AS top_sql, min_by(strategy, rank) AS top_strategy, string_agg(CAST(position AS VARCHAR), ',' ORDER BY rank) AS ranks
  FROM ranked GROUP BY stmt),
flat AS (
  SELECT s.stmt, s.query, s.mean_exec_time, s.calls, s.p_slow, s.predicted_ms,
         NOT s.stmt LIKE '%:click' AS found, l.n, l.names, l.top_sql, l.top_strategy, l.ranks,
         v.verified_cold_ms, v.verified_warm_ms, v.measured_speedup_ms
  FROM scored s JOIN lists l USING (stmt) JOIN verified v USING (stmt) WHERE s.p_slow >= 0.5)"""

SQL_LOG = SQL_EVENTS + """, log AS (
  SELECT query, round_even(mean_exec_time, 2) AS avg_time_ms, round_even(round_even(p_slow, 4) * 100, 1) AS confidence,
         'Query optimization strategies: ' || names AS reason, top_sql AS fix, top_strategy AS strategy,
         CASE WHEN round_even(measured_speedup_ms, 2) > 0 THEN round_even(round_even(measured_speedup_ms, 2), 1) ELSE 0.0 END AS speedup_ms,
         verified_warm_ms IS NOT NULL AS measured, verified_warm_ms AS warm_median_ms, round_even(p_slow, 4) >= 0.5 AS flagged,
         '2024-01-31T00:00:00' AS timestamp, 'sqlcoder_finetuned' AS llm_source, 'slow_query_handled' AS type
  FROM flat WHERE found
  UNION ALL
  SELECT query, mean_exec_time, round_even(p_slow * 100, 1), 'old record', 'CREATE INDEX', '',
         CASE WHEN calls % 2 = 0 THEN round_even(mean_exec_time - 45, 1) ELSE 0.0 END,
         calls % 2 = 0 AND round_even(mean_exec_time - 45, 1) > 0, NULL, mean_exec_time > 50,
         '2023-12-31T00:00:00', 'gpt', 'slow_query_handled'
  FROM scored WHERE p_slow < 0.5)"""

SQL_PROTOCOL = """ordered AS (
  SELECT user_id, event_type, least(value, 300.0) AS ms,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events),
cold AS (SELECT user_id, event_type, ms AS cold FROM ordered WHERE nth = 1),
kept AS (
  SELECT o.*, cold FROM ordered o JOIN cold USING (user_id, event_type)
  WHERE nth <= 1 + CASE WHEN cold >= 300 OR cold > 2000 THEN 1 WHEN cold > 500 THEN 2 ELSE 5 END),
protocol AS (
  SELECT user_id, event_type, round_even(any_value(cold), 2) AS execution_time_cold_ms,
         round_even(coalesce(median(ms) FILTER (nth > 1), any_value(cold)), 2) AS execution_time_warm_ms,
         round_even(coalesce(stddev_pop(ms) FILTER (nth > 1), 0), 2) AS execution_time_warm_std_ms,
         string_agg(printf('%.2f', ms), ';' ORDER BY nth) AS all_runs_ms,
         CAST(count(*) FILTER (ms >= 300) AS INTEGER) AS timed_out_runs,
         CASE WHEN round_even(coalesce(median(ms) FILTER (nth > 1), any_value(cold)), 2) > 35 THEN 'slow' ELSE 'fast' END AS label
  FROM kept GROUP BY user_id, event_type)"""

SQL_MEASUREMENTS = SQL_PROTOCOL + """, every AS (
  SELECT user_id, event_type, max(ms) FILTER (nth = 1) AS cold, coalesce(median(ms) FILTER (nth > 1), max(ms)) AS warm,
         coalesce(stddev_pop(ms) FILTER (nth > 1), 0) AS deviation, CAST(count(*) FILTER (ms >= 300) AS INTEGER) AS timed_out_runs
  FROM ordered GROUP BY user_id, event_type),
measurements AS (
  SELECT user_id, event_type, round_even(cold, 2) AS execution_time_cold_ms, round_even(warm, 2) AS execution_time_warm_ms,
         round_even(deviation, 2) AS execution_time_warm_std_ms, p.all_runs_ms, e.timed_out_runs, CASE WHEN warm > 35 THEN 'slow' ELSE 'fast' END AS label
  FROM every e JOIN protocol p USING (user_id, event_type))"""

SQL_PAIRS = """pairs AS (
  SELECT a.conv_id || '-' || b.turn AS pair_id, a.conv_id, b.turn, a.text AS slow, b.text AS optimized
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""

SQL_PREDICTIONS = """predictions AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS row_id, l_extendedprice / 100 AS true_ms,
         ln(1 + l_extendedprice / 100) AS true_log, CAST(l_extendedprice > 60000 AS INTEGER) AS actual,
         (l_quantity - 25) / 5 AS logit, 1 / (1 + exp(-(l_quantity - 25) / 5)) AS p_slow,
         CAST(l_quantity > 25 AS INTEGER) AS predicted, ln(l_quantity * 20 + 50) AS predicted_log, l_returnflag AS fold
  FROM lineitem)"""
