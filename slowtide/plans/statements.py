"""Query-log operators on statements: features, run summaries, candidates and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from slowtide.functions import numeric as N
from slowtide.functions import text as T
from slowtide.functions.plantree import NODE_FLAGS, PLAN_FEATURES, plan_features, plan_rejected
from slowtide.operators import candidates as C
from slowtide.operators import reports, runs
from slowtide.plans import fixtures as X
from slowtide.plans.fixtures import Log
from slowtide.plans.relational import r4

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col


def _add(name, build, sql=None):
    QUERIES[name] = lambda spark, folder: build(Log(spark, folder))
    if sql:
        CHECKS[name] = X.exact_rounding(sql)


# ---- scalar functions of the log

_add(
    "f05_log_and_clip",
    lambda t: t.orders.select(
        "o_orderkey",
        r4(F.log1p("o_totalprice"), "logged"),
        r4(N.log_ms_to_ms(F.log1p("o_totalprice") - 3), "ms"),
    ),
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 4) AS logged,
         round(exp(least(9.21, greatest(-1, ln(1 + o_totalprice) - 3))) - 1, 4) AS ms FROM orders""",
)
_add(
    "f06_sigmoid",
    lambda t: t.events.select("event_id", r4(N.sigmoid((c("value") - 50) / 10), "p")),
    "SELECT event_id, round(1 / (1 + exp(-(value - 50) / 10)), 4) AS p FROM events",
)
_add(
    "f07_log10_floor",
    lambda t: t.events.select("event_id", r4(N.log10_floor(c("value"), 0.05), "x")),
    "SELECT event_id, round(log10(greatest(value, 0.05)), 4) AS x FROM events",
)
_add(
    "f09_count_substring",
    lambda t: t.documents.select("doc_id", T.occurrences(c("text"), "th").alias("n")),
    "SELECT doc_id, CAST(len(regexp_extract_all(text, 'th')) AS INTEGER) AS n FROM documents",
)
_add(
    "f10_regex_replace",
    lambda t: t.pages.select("page_id", F.regexp_replace("html", r"(?is)<script.*?</script>", "").alias("html")),
    "SELECT page_id, regexp_replace(html, '(?is)<script.*?</script>', '', 'g') AS html FROM pages",
)
_add(
    "f11_run_lists",
    lambda t: t.lineitem.select(
        N.format_runs(F.array("l_quantity", "l_extendedprice", "l_tax")).alias("runs"),
        r4(F.aggregate(N.parse_runs(F.concat_ws(";", "l_quantity", "l_discount")), F.lit(0.0), lambda s, x: s + x), "total"),
    ),
    """SELECT printf('%.2f;%.2f;%.2f', l_quantity, l_extendedprice, l_tax) AS runs, round(l_quantity + l_discount, 4) AS total
       FROM lineitem""",
)
_add(
    "f12_half_even",
    lambda t: t.events.select("event_id", N.half_even(c("value") / 4, 1).alias("one"), N.half_even(c("value"), 0).alias("none")),
    "SELECT event_id, round_even(value / 4, 1) AS one, round_even(value, 0) AS none FROM events",
)
_add(
    "f13_ascii_only",
    lambda t: t.documents.select("doc_id", F.regexp_replace("text", r"[^\x00-\x7F]", "").alias("text")),
    "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text FROM documents",
)

# ---- text and plan features

_add(
    "d01_text_features",
    lambda t: t.stats.select("stmt", *[v.alias(k) for k, v in T.text_features(c("query")).items()]),
    f"WITH {X.SQL_STATS} SELECT stmt, {X.sql_features('query')} FROM stats",
)
_add(
    "d02_placeholders",
    lambda t: t.stats.select("stmt", T.fill_placeholders(c("query")).alias("query")),
    f"WITH {X.SQL_STATS} SELECT stmt, replace(replace(query, '$12', '1'), '$1', '1') AS query FROM stats",
)


def _plan_documents(t):
    """One plan per lineitem: a chain as deep as its line number, some malformed."""
    leaf_type = F.when(c("l_returnflag") == "A", "Seq Scan").when(c("l_returnflag") == "N", "Bitmap Index Scan").otherwise("Index Only Scan")
    leaf = F.concat(
        F.lit('{"Node Type": "'), leaf_type, F.lit('", "Shared Hit Blocks": '), c("l_suppkey").cast("string"),
        F.lit(', "Shared Read Blocks": '), c("l_partkey").cast("string"), F.lit("}"),
    )
    inner = c("l_linenumber") - 1
    chain = F.concat(
        F.repeat(F.lit('{"Node Type": "Nested Loop", "Shared Hit Blocks": 1, "Plans": ['), inner), leaf, F.repeat(F.lit("]}"), inner)
    )
    second = F.when(c("l_quantity") > 25, ', {"Node Type": "Materialize", "Shared Read Blocks": 5}').otherwise("")
    whole = F.concat(
        F.lit('[{"Plan": {"Node Type": "'), F.when(c("l_linestatus") == "F", "Hash Join").otherwise("Merge Join"),
        F.lit('", "Total Cost": '), c("l_extendedprice").cast("string"), F.lit(', "Plan Rows": '), c("l_orderkey").cast("string"),
        F.lit(', "Actual Rows": 3, "Plans": ['), chain, second, F.lit(']}, "Execution Time": 1.5}]'),
    )
    document = F.when(c("l_tax") == 0, F.substring(whole, 1, 40)).otherwise(whole)
    return t.lineitem.repartition("l_orderkey", "l_linenumber").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), document.alias("document")
    )


def _plan_rows(t):
    plans = _plan_documents(t).select("row_id", plan_features(c("document")).alias("p"), plan_rejected(c("document")).alias("plan_rejected"))
    return plans.select("row_id", "plan_rejected", *[c(f"p.{f}").alias(f) for f in PLAN_FEATURES])


_FLAG_SQL = {
    "has_seq_scan": "l_returnflag = 'A'",
    "has_index_scan": "l_returnflag <> 'A'",
    "has_bitmap_scan": "l_returnflag = 'N'",
    "has_hash_join": "l_linestatus = 'F'",
    "has_nested_loop": "l_linenumber > 1",
    "has_merge_join": "l_linestatus <> 'F'",
}
_add(
    "d03_plan_features",
    _plan_rows,
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS row_id, l_tax = 0 AS plan_rejected,
         CASE WHEN l_tax = 0 THEN 0 ELSE l_extendedprice END AS plan_total_cost,
         CASE WHEN l_tax = 0 THEN 0 ELSE l_orderkey END AS plan_rows,
         CAST(CASE WHEN l_tax = 0 THEN 0 ELSE 3 END AS BIGINT) AS actual_rows,
         CASE WHEN l_tax = 0 THEN 0 ELSE l_linenumber END AS plan_depth,
         CASE WHEN l_tax = 0 THEN 0 ELSE l_suppkey + l_linenumber - 1 END AS shared_hit,
         CASE WHEN l_tax = 0 THEN 0 ELSE l_partkey + CASE WHEN l_quantity > 25 THEN 5 ELSE 0 END END AS shared_read, """
    + ", ".join(f"CAST(l_tax <> 0 AND {_FLAG_SQL[n]} AS INTEGER) AS {n}" for n in NODE_FLAGS)
    + " FROM lineitem",
)

# ---- runs, labels, detection

_add(
    "d04_run_summary",
    lambda t: t.summaries.select(
        "user_id", "event_type", "cold_ms", r4(c("warm_ms"), "warm_ms"), r4(c("warm_std_ms"), "warm_std_ms"), "n_runs", "timed_out_runs"
    ),
    f"""WITH {X.SQL_SUMMARY} SELECT user_id, event_type, cold_ms, round(warm_ms, 4) AS warm_ms,
         round(warm_std_ms, 4) AS warm_std_ms, n_runs, timed_out_runs FROM summaries""",
)
_add(
    "d05_measurements",
    lambda t: t.protocol,
    f"WITH {X.SQL_PROTOCOL} SELECT * FROM protocol",
)
_add(
    "d06_slow_label",
    lambda t: t.summaries.select("user_id", "event_type", runs.slow_label(c("warm_ms"), X.LABEL_MS).alias("label")),
    f"WITH {X.SQL_SUMMARY} SELECT user_id, event_type, CASE WHEN warm_ms > 35 THEN 'slow' ELSE 'fast' END AS label FROM summaries",
)
_add(
    "d07_slow_statements",
    lambda t: runs.slow_statements(t.stats, X.DETECT_MS).select("query", F.round("mean_exec_time", 6).alias("mean_exec_time"), "calls"),
    f"""WITH {X.SQL_STATS} SELECT query, round(mean_exec_time, 6) AS mean_exec_time, calls FROM stats
       WHERE mean_exec_time > 50 AND query NOT LIKE '%pg_stat_statements%' AND query NOT LIKE '%EXPLAIN%'
         AND query NOT LIKE '%SET%' AND query ILIKE '%SELECT%' ORDER BY mean_exec_time DESC, query LIMIT 10""",
)
_add(
    "d08_first_seen",
    lambda t: runs.first_seen(t.documents, runs.statement_key(c("text")), [c("doc_id")]).select("doc_id", "text"),
    """SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n
         FROM documents) WHERE n = 1""",
)
_add(
    "d09_gate",
    lambda t: C.gate(t.scored).select("stmt", r4(c("p_slow"), "p_slow")),
    f"WITH {X.SQL_SCORED} SELECT stmt, round(p_slow, 4) AS p_slow FROM scored WHERE NOT p_slow < 0.5",
)
_add(
    "d10_score",
    lambda t: t.scored.select("stmt", r4(c("p_slow"), "p_slow"), r4(c("predicted_ms"), "predicted_ms")),
    f"WITH {X.SQL_SCORED} SELECT stmt, round(p_slow, 4) AS p_slow, round(predicted_ms, 4) AS predicted_ms FROM scored",
)

# ---- candidates

_add(
    "d11_rank_candidates",
    lambda t: t.ranked.select("stmt", "sql", r4(c("predicted_ms"), "predicted_ms"), r4(c("predicted_speedup_ms"), "predicted_speedup_ms"), c("rank").cast("bigint").alias("rank")),
    f"""WITH {X.SQL_RANKED} SELECT stmt, sql, round(predicted_ms, 4) AS predicted_ms,
         round(predicted_speedup_ms, 4) AS predicted_speedup_ms, rank FROM ranked""",
)
_add(
    "d12_strategy",
    lambda t: t.candidates.select("stmt", "sql", "strategy"),
    f"WITH {X.SQL_RANKED} SELECT stmt, sql, strategy FROM labelled",
)
_add(
    "d13_valid_candidates",
    lambda t: t.answers.select("stmt", "position", T.is_candidate(T.answer_sql(c("raw"))).alias("valid")),
    f"WITH {X.SQL_CANDIDATES} SELECT stmt, CAST(position AS INTEGER) AS position, t <> 'error' AS valid FROM others",
)
_add(
    "d14_answer_sql",
    lambda t: t.answers.select("stmt", "position", T.clean_candidate(T.answer_sql(c("raw"))).alias("sql")),
    f"WITH {X.SQL_CANDIDATES} SELECT stmt, CAST(position AS INTEGER) AS position, sql FROM texts",
)
_add(
    "d15_distinct_candidates",
    lambda t: t.candidates.select("stmt", "position", "sql"),
    f"WITH {X.SQL_CANDIDATES} SELECT stmt, CAST(position AS INTEGER) AS position, sql FROM candidates",
)
_add(
    "d16_verify",
    lambda t: t.verified.select("stmt", "sql", "verified_cold_ms", "verified_warm_ms", F.round("measured_speedup_ms", 6).alias("measured_speedup_ms")),
    f"""WITH {X.SQL_VERIFIED} SELECT stmt, sql, verified_cold_ms, verified_warm_ms,
         round(measured_speedup_ms, 6) AS measured_speedup_ms FROM verified""",
)
_add(
    "d17_wins",
    lambda t: C.wins(t.verified).withColumn("speedup_ms", F.round("speedup_ms", 6)),
    f"""WITH {X.SQL_VERIFIED} SELECT query AS slow_query, sql AS fix, round(measured_speedup_ms, 6) AS speedup_ms
       FROM verified WHERE measured_speedup_ms > 0""",
)


def _rewrite_equality(t):
    """A correlated subquery against its join rewrite, and against the same rewrite with a filter lost."""
    nested = t.users.join(
        t.posts.groupBy("owner_user_id").agg(F.count("*").alias("n")), c("id") == c("owner_user_id"), "left"
    ).select("id", F.coalesce("n", F.lit(0)).alias("n"))
    counted = t.users.select("id").join(t.posts.select("owner_user_id", c("id").alias("post")), c("id") == c("owner_user_id"), "left")
    joined = counted.groupBy("id").agg(F.count("post").alias("n"))
    good = C.same_rows(nested, joined).withColumn("rewrite", F.lit("left join"))
    bad = C.same_rows(nested, joined.filter("n > 5")).withColumn("rewrite", F.lit("filtered"))
    return good.unionByName(bad)


_add(
    "d17_same_rows",
    _rewrite_equality,
    """WITH joined AS (SELECT c_custkey AS id, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
       SELECT TRUE AS equal, 'left join' AS rewrite UNION ALL
       SELECT (SELECT count(*) FROM joined WHERE n <= 5) = 0, 'filtered'""",
)
_add(
    "d18_events",
    lambda t: t.assembled.select(
        "stmt",
        "type",
        "query",
        "pg_stat_mean_ms",
        "calls",
        F.coalesce("model.p_slow", F.round("p_slow", 4)).alias("p_slow"),
        F.coalesce(F.array_size("candidates_ranked"), F.lit(0)).cast("bigint").alias("n_candidates"),
        F.get("candidates_ranked", F.lit(0))["sql"].alias("top_sql"),
        "reason",
        c("top_candidate_verified.warm_median_ms").alias("warm_median_ms"),
        "measured_speedup_ms",
    ),
    f"""WITH {X.SQL_EVENTS} SELECT stmt, CASE WHEN found THEN 'slow_query_handled' ELSE 'no_candidates' END AS type, query,
         CASE WHEN found THEN round_even(mean_exec_time, 2) END AS pg_stat_mean_ms, CASE WHEN found THEN calls END AS calls,
         round(p_slow, 4) AS p_slow, CASE WHEN found THEN n ELSE 0 END AS n_candidates, CASE WHEN found THEN top_sql END AS top_sql,
         'Query optimization strategies: ' || CASE WHEN found THEN names ELSE '' END AS reason,
         CASE WHEN found THEN verified_warm_ms END AS warm_median_ms,
         CASE WHEN found THEN round_even(measured_speedup_ms, 2) END AS measured_speedup_ms FROM flat""",
)
_add(
    "d19_normalised_log",
    lambda t: reports.normalise_log(t.log).withColumn("avg_time_ms", F.round("avg_time_ms", 6)),
    f"WITH {X.SQL_LOG} SELECT * REPLACE (round(avg_time_ms, 6) AS avg_time_ms) FROM log",
)
_add(
    "d20_dashboard_stats",
    lambda t: reports.dashboard_stats(reports.normalise_log(t.log)),
    f"""WITH {X.SQL_LOG} SELECT count(*) AS total, count(*) FILTER (flagged) AS flagged, count(*) FILTER (speedup_ms > 0) AS fixed,
         round_even(avg(speedup_ms) FILTER (speedup_ms > 0), 1) AS avg_speedup,
         round_even(sum(speedup_ms) FILTER (speedup_ms > 0), 0) AS total_saved_ms FROM log""",
)
_add(
    "d21_before_after",
    lambda t: reports.before_after(reports.normalise_log(t.log)).select(
        "query", *[r4(c(n), n) for n in ("before_ms", "after_ms", "before_pct", "after_pct")]
    ),
    f"""WITH {X.SQL_LOG}, both_times AS (
         SELECT query, avg_time_ms AS b, CASE WHEN warm_median_ms IS NULL THEN greatest(0, avg_time_ms - speedup_ms) ELSE warm_median_ms END AS a
         FROM log WHERE measured AND speedup_ms > 0)
       SELECT query, round(b, 4) AS before_ms, round(a, 4) AS after_ms,
         round(greatest(3, 100 * b / greatest(a, b, 1)), 4) AS before_pct, round(greatest(3, 100 * a / greatest(a, b, 1)), 4) AS after_pct
       FROM both_times""",
)
_add(
    "j22_label_lookup",
    lambda t: C.strategy_of(t.ranked, t.candidates.filter(c("strategy") != T.ADD_LIMIT), "stmt").select("stmt", "sql", "strategy"),
    f"WITH {X.SQL_RANKED} SELECT stmt, sql, CASE WHEN strategy = 'add LIMIT' THEN '' ELSE strategy END AS strategy FROM labelled",
)
_add(
    "s11_statement_statistics",
    lambda t: t.stats.select("query", F.round("mean_exec_time", 6).alias("mean_exec_time"), "calls"),
    f"WITH {X.SQL_STATS} SELECT query, round(mean_exec_time, 6) AS mean_exec_time, calls FROM stats",
)
