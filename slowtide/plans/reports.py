"""Reports, sampling, pair preparation and template expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from slowtide.functions import text as T
from slowtide.operators import pairs as P
from slowtide.operators import reports as R
from slowtide.operators import templates
from slowtide.plans import fixtures as X
from slowtide.plans.fixtures import Log
from slowtide.plans.relational import r4
from slowtide.plans.stack import on_stack

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col


def _add(name, build, sql=None):
    QUERIES[name] = lambda spark, folder: build(Log(spark, folder))
    if sql:
        CHECKS[name] = X.exact_rounding(sql)


# ---- evaluation reports


def _evaluation(t):
    """Every order as one evaluated statement with the results of two approaches."""
    base = c("o_totalprice")
    first = R.speedup_pct(base, F.lit(250000.0))
    second = R.speedup_pct(base, base * 0.9 + 5000)
    late = c("o_orderstatus") == "P"
    return t.orders.select(
        F.when(~late, first).alias("simple_speedup_pct"), late.alias("simple_broken"),
        second.alias("full_speedup_pct"), F.lit(False).alias("full_broken"),
    )


_add(
    "d22_approach_summary",
    lambda t: R.approach_summary(_evaluation(t), ["simple", "full"]).select(
        "approach", r4(c("avg_speedup_pct"), "avg_speedup_pct"), r4(c("win_rate_pct"), "win_rate_pct"), r4(c("broken_rate_pct"), "broken_rate_pct")
    ),
    """SELECT 'simple' AS approach, round(avg((o_totalprice - 250000) / o_totalprice * 100) FILTER (o_orderstatus <> 'P'), 4) AS avg_speedup_pct,
         round(100.0 * count(*) FILTER (o_orderstatus <> 'P' AND o_totalprice > 250000) / count(*) FILTER (o_orderstatus <> 'P'), 4) AS win_rate_pct,
         round(100.0 * count(*) FILTER (o_orderstatus = 'P') / count(*), 4) AS broken_rate_pct FROM orders
       UNION ALL SELECT 'full', round(avg((o_totalprice * 0.1 - 5000) / o_totalprice * 100), 4),
         round(100.0 * count(*) FILTER (o_totalprice * 0.1 > 5000) / count(*), 4), 0.0 FROM orders""",
)


def _checked(t):
    rows = t.predictions.withColumns(
        {
            "actual_ms": c("true_ms"),
            "predicted_ms": F.expm1("predicted_log"),
            "actual_label": F.when(c("actual") == 1, "slow").otherwise("fast"),
        }
    )
    return R.spot_check(rows)


_add(
    "d23_spot_check_rows",
    lambda t: _checked(t).select("row_id", "predicted_label", "verdict", r4(c("error_ms"), "error_ms")),
    f"""WITH {X.SQL_PREDICTIONS} SELECT row_id, CASE WHEN p_slow > 0.5 THEN 'slow' ELSE 'fast' END AS predicted_label,
         CASE WHEN (p_slow > 0.5) = (actual = 1) THEN 'OK' ELSE 'MISS' END AS verdict,
         round(exp(predicted_log) - 1 - true_ms, 4) AS error_ms FROM predictions""",
)
_add(
    "d23_spot_check_summary",
    lambda t: R.spot_check_summary(_checked(t)).select(
        "n", "correct", r4(c("accuracy_pct"), "accuracy_pct"), r4(c("log_mae"), "log_mae"), r4(c("factor"), "factor")
    ),
    f"""WITH {X.SQL_PREDICTIONS} SELECT count(*) AS n, count(*) FILTER ((p_slow > 0.5) = (actual = 1)) AS correct,
         round(100.0 * count(*) FILTER ((p_slow > 0.5) = (actual = 1)) / count(*), 4) AS accuracy_pct,
         round(avg(abs(ln(true_ms + 1) - predicted_log)), 4) AS log_mae,
         round(exp(avg(abs(ln(true_ms + 1) - predicted_log))), 4) AS factor FROM predictions""",
)


def _run_results(t):
    """Every order as one result of a monitored run."""
    saved = c("o_totalprice") - 200000
    return t.orders.select(
        c("o_orderpriority").alias("pattern"),
        F.when(c("o_orderstatus") == "P", "skipped_below_threshold").when(saved > 0, "win").otherwise("loss").alias("result"),
        F.when(c("o_orderstatus") != "P", saved).alias("measured_speedup_ms"),
        F.when(c("o_orderstatus") != "P", c("o_totalprice") / 200000).alias("speedup_factor"),
        (c("o_custkey") % 4 != 0).alias("similar_fix_found"),
        ((c("o_custkey") % 4) / 4).alias("similar_fix_similarity"),
        F.when(c("o_custkey") % 3 == 0, T.ADD_LIMIT).when(c("o_custkey") % 3 == 1, T.TO_JOIN).alias("strategy"),
    )


_RUN_RESULTS_SQL = """results AS (
  SELECT o_orderpriority AS pattern, CASE WHEN o_orderstatus = 'P' THEN 'skipped_below_threshold' WHEN o_totalprice > 200000 THEN 'win' ELSE 'loss' END AS result,
         o_totalprice - 200000 AS saved, o_totalprice / 200000 AS factor, o_custkey % 4 AS m,
         CASE o_custkey % 3 WHEN 0 THEN 'add LIMIT' WHEN 1 THEN 'rewrite subquery as JOIN' ELSE 'unknown' END AS strategy FROM orders)"""
_add(
    "d24_run_result_summary",
    lambda t: R.run_result_summary(_run_results(t)).select(
        "total", "wins", "attempted", "skipped", "best_pattern", "similar_found",
        *[r4(c(n), n) for n in ("win_rate_pct", "mean_saved_ms", "median_saved_ms", "best_saved_ms", "mean_factor", "best_factor", "skip_rate_pct", "mean_similarity")],
        F.round("total_saved_ms", 2).alias("total_saved_ms"),
    ),
    f"""WITH {_RUN_RESULTS_SQL} SELECT count(*) AS total, count(*) FILTER (result = 'win') AS wins,
         count(*) FILTER (result <> 'skipped_below_threshold') AS attempted, count(*) FILTER (result = 'skipped_below_threshold') AS skipped,
         arg_max(pattern, saved) FILTER (result = 'win') AS best_pattern, count(*) FILTER (m <> 0) AS similar_found,
         round(100.0 * count(*) FILTER (result = 'win') / count(*) FILTER (result <> 'skipped_below_threshold'), 4) AS win_rate_pct,
         round(avg(saved) FILTER (result = 'win'), 4) AS mean_saved_ms, round(median(saved) FILTER (result = 'win'), 4) AS median_saved_ms,
         round(max(saved) FILTER (result = 'win'), 4) AS best_saved_ms, round(avg(factor) FILTER (result = 'win'), 4) AS mean_factor,
         round(max(factor) FILTER (result = 'win'), 4) AS best_factor,
         round(100.0 * count(*) FILTER (result = 'skipped_below_threshold') / count(*), 4) AS skip_rate_pct,
         round(avg(m / 4) FILTER (m <> 0), 4) AS mean_similarity, round(sum(saved) FILTER (result = 'win'), 2) AS total_saved_ms FROM results""",
)
_add(
    "d25_strategy_breakdown",
    lambda t: R.strategy_breakdown(_run_results(t)),
    f"WITH {_RUN_RESULTS_SQL} SELECT strategy, count(*) AS wins FROM results WHERE result = 'win' GROUP BY strategy",
)
_add(
    "d38_generation_report",
    lambda t: R.generation_report(t.measurements),
    f"""WITH {X.SQL_MEASUREMENTS} SELECT count(*) FILTER (label = 'slow') AS slow, count(*) FILTER (label = 'fast') AS fast,
         count(*) AS total FROM measurements""",
)

# ---- pairs


def _page_pairs(t):
    """Pages as pairs: the url as slow text, a query built around the page as rewrite; drafts are no queries."""
    prefix = F.when(F.length("url") % 5 == 0, "DRAFT ").otherwise(" SELECT u.99 FROM x -- ")
    return t.pages.select("page_id", c("url").alias("slow"), F.concat(prefix, c("html")).alias("optimized"))


_PAGE_PAIRS_SQL = """raw AS (SELECT page_id, url AS slow, CASE WHEN length(url) % 5 = 0 THEN 'DRAFT ' ELSE ' SELECT u.99 FROM x -- ' END || html AS optimized FROM pages),
cleaned AS (
  SELECT page_id, slow AS old_slow, optimized AS old_optimized,
         regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(slow, '&[a-zA-Z]+;', '', 'g'), 'u.99', 'u.id'), 'p.99', 'p.id'), 'v.99', 'v.id'), '[^\\x00-\\x7F]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS slow,
         regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(optimized, '&[a-zA-Z]+;', '', 'g'), 'u.99', 'u.id'), 'p.99', 'p.id'), 'v.99', 'v.id'), '[^\\x00-\\x7F]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS optimized
  FROM raw)"""
_add(
    "d26_clean_pairs",
    lambda t: P.clean_pairs(_page_pairs(t)).filter("kept").select("page_id", "slow", "optimized"),
    f"WITH {_PAGE_PAIRS_SQL} SELECT page_id, slow, optimized FROM cleaned WHERE optimized ILIKE 'SELECT%' AND optimized ILIKE '%FROM%'",
)
_add(
    "d26_cleaning_report",
    lambda t: P.cleaning_report(P.clean_pairs(_page_pairs(t))),
    f"""WITH {_PAGE_PAIRS_SQL} SELECT count(*) AS before, count(*) FILTER (slow <> old_slow OR optimized <> old_optimized) AS fixed,
         count(*) FILTER (NOT (optimized ILIKE 'SELECT%' AND optimized ILIKE '%FROM%')) AS removed,
         count(*) FILTER (optimized ILIKE 'SELECT%' AND optimized ILIKE '%FROM%') AS after FROM cleaned""",
)


def _pending(t):
    done = t.verified.filter("measured_speedup_ms > 0").select(c("query").alias("slow"))
    return P.pending(t.measurements, done).select("query_text")


_PENDING = f"""WITH {X.SQL_VERIFIED}, {X.SQL_MEASUREMENTS}, texts2 AS (
         SELECT {X.sql_text_of(X.TEXTS, 'event_type', 'user_id')} AS query_text FROM measurements WHERE label = 'slow')
       SELECT query_text FROM texts2 WHERE query_text NOT IN (SELECT query FROM verified WHERE measured_speedup_ms > 0)"""
_add("d27_pending", _pending, _PENDING)


def _resumed(t):
    """A job that takes up where it stopped: statements of which no long run is in its log yet."""
    done = t.events.filter(c("value") >= 2 * X.LABEL_MS).select(*X.KEYS).distinct()
    return t.stats.join(done, X.KEYS, "left_anti").select("user_id", "event_type", "calls")


_add(
    "j21_resume_anti_join",
    _resumed,
    "SELECT user_id, event_type, count(*) AS calls FROM events GROUP BY ALL HAVING max(value) < 70",
)


def _prompts(t):
    fixes = t.pairs.filter(F.length("slow") > 300).select(
        "pair_id", c("slow").alias("slow_query"), c("optimized").alias("fix"), F.lit(12.5).alias("speedup_ms")
    )
    return P.prompts(t.pairs, fixes)


_SCHEMA_SQL = (
    "CREATE TABLE posts (id INT, post_type_id INT, owner_user_id INT, title TEXT, score INT, view_count INT, answer_count INT, creation_date TIMESTAMP);\n"
    "CREATE TABLE users (id INT, display_name TEXT, location TEXT, reputation INT, creation_date TIMESTAMP);\n"
    "CREATE TABLE votes (id INT, post_id INT, vote_type_id INT, creation_date TIMESTAMP);"
)
_add(
    "d28_prompts",
    _prompts,
    f"""WITH {X.SQL_PAIRS}, s AS (SELECT *, regexp_replace(slow, '^\\s+|\\s+$', '', 'g') AS q FROM pairs)
       SELECT pair_id, '### Task' || chr(10) || 'Rewrite the following slow PostgreSQL query to be faster.' || chr(10) || chr(10)
         || '### Database Schema' || chr(10) || '{_SCHEMA_SQL}'
         || CASE WHEN length(slow) > 300 THEN chr(10) || chr(10) || 'A similar slow query was previously fixed:' || chr(10) || 'Slow: ' || slow
              || chr(10) || 'Fix: ' || optimized || chr(10) || 'Speedup: 12.5ms' || chr(10) ELSE '' END
         || chr(10) || chr(10) || '### Slow Query' || chr(10) || q || chr(10) || chr(10) || '### Optimized Query' || chr(10) AS prompt,
         regexp_replace(optimized, '^\\s+|\\s+$', '', 'g') AS target FROM s""",
)
_add(
    "d29_seeded_split",
    lambda t: P.split_rows(t.documents.select("doc_id"), "doc_id", 42, 0.1),
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER () * 0.1)
         THEN 'val' ELSE 'train' END AS split FROM documents""",
)

# ---- query tables


def _draws(t):
    return t.supplier.select(c("s_suppkey").alias("draw"))


def _expanded(t):
    return templates.expand(_draws(t), "draw", templates.limits(t.users, t.posts, t.votes))


# The statements as SQL builds them, from pieces restated here.
_PIECES = """source AS (SELECT * FROM (VALUES ('u', 'users u'), ('p', 'posts p'), ('up', 'users u JOIN posts p ON p.owner_user_id = u.id'),
    ('pv', 'posts p JOIN votes v ON v.post_id = p.id'), ('upv', 'users u JOIN posts p ON p.owner_user_id = u.id JOIN votes v ON v.post_id = p.id')) AS s(tables, source)),
condition AS (SELECT * FROM (VALUES ('u', 'u.reputation >= {reputation}'), ('u', 'u.location = (SELECT location FROM users WHERE id = {user})'),
    ('p', 'p.score BETWEEN {score} AND {score} + 60'), ('p', 'EXTRACT(YEAR FROM p.creation_date) = {year}'), ('v', 'v.vote_type_id <= {vote}')) AS c(needs, condition)),
part AS (SELECT * FROM (VALUES ('u', 'u.location'), ('p', 'p.post_type_id'), ('p', 'EXTRACT(MONTH FROM p.creation_date)')) AS g(needs, part)),
statement AS (
  SELECT 'rows' AS family, 'SELECT ' || tables[1] || '.id FROM ' || source || ' WHERE ' || condition || ' ORDER BY 1 LIMIT {n}' AS text
  FROM source, condition WHERE contains(tables, needs)
  UNION ALL SELECT 'grouped', 'SELECT ' || part || ' AS part, ' || fold || ' AS result FROM ' || source || ' GROUP BY ' || part
  FROM source, part, unnest(['COUNT(*)', 'AVG(p.score)', 'MAX(p.view_count)']) AS f(fold) WHERE contains(tables, needs) AND tables IN ('up', 'pv', 'upv')
  UNION ALL SELECT shape.family, replace(shape.text, '@', part) FROM part, (VALUES
    ('having', 'SELECT @ AS part, COUNT(*) AS total FROM users u JOIN posts p ON p.owner_user_id = u.id GROUP BY @ HAVING COUNT(*) >= {few} AND MAX(p.score) >= {score}'),
    ('with', 'WITH totals AS (SELECT @ AS part, COUNT(*) AS total FROM users u JOIN posts p ON p.owner_user_id = u.id GROUP BY @) SELECT part FROM totals WHERE total > {few} ORDER BY total DESC, part LIMIT {n}'),
    ('case', 'SELECT @ AS part, SUM(CASE WHEN v.vote_type_id <= {vote} THEN 1 ELSE 0 END) AS hits FROM users u JOIN posts p ON p.owner_user_id = u.id JOIN votes v ON v.post_id = p.id GROUP BY @')) AS shape(family, text)
  UNION ALL SELECT 'exists', 'SELECT t.id FROM ' || t || ' WHERE ' || word || 'EXISTS (SELECT 1 FROM ' || link || ')' FROM unnest(['', 'NOT ']) AS w(word), (VALUES
    ('users t', 'posts p WHERE p.owner_user_id = t.id AND p.score >= {score}'), ('posts t', 'votes v WHERE v.post_id = t.id AND v.vote_type_id <= {vote}')) AS l(t, link)
  UNION ALL SELECT 'sets', 'SELECT p.post_type_id, p.score FROM posts p WHERE p.score >= {score} ' || j || ' SELECT p.post_type_id, p.score FROM posts p WHERE p.post_type_id = {kind}'
  FROM unnest(['UNION', 'UNION ALL', 'EXCEPT']) AS x(j)
  UNION ALL SELECT 'window', 'SELECT p.id, ' || r || ' OVER (PARTITION BY p.post_type_id ORDER BY p.score DESC, p.id) AS place FROM posts p'
  FROM unnest(['RANK()', 'ROW_NUMBER()', 'SUM(p.score)', 'LAG(p.id)']) AS x(r)
  UNION ALL SELECT * FROM (VALUES ('lookup', 'SELECT * FROM users WHERE id = {user}'), ('lookup', 'SELECT score, view_count FROM posts WHERE id >= {post} ORDER BY id LIMIT 1'),
    ('dates', 'SELECT EXTRACT(YEAR FROM creation_date) AS y, COUNT(*) AS total FROM votes WHERE EXTRACT(MONTH FROM creation_date) = {month} GROUP BY 1'),
    ('pairs', 'SELECT l.id AS one, r.id AS other FROM posts l JOIN posts r ON r.owner_user_id = l.owner_user_id AND r.id > l.id ORDER BY 1, 2 LIMIT {n}'),
    ('scalar', 'SELECT u.id, (SELECT COUNT(*) FROM posts p WHERE p.owner_user_id = u.id AND p.score >= {score}) AS total FROM users u WHERE u.reputation >= {reputation}')) AS v(family, text)),
numbered AS (SELECT CAST(row_number() OVER (ORDER BY text) - 1 AS INTEGER) AS template, family, text, count(*) OVER () AS many FROM statement)"""


def _expanded_sql() -> str:
    """The composed statements filled in SQL: the same seeded hash between the least and the greatest value."""
    bounds = {
        "reputation": ("min(reputation)", "max(reputation)", "users"), "user": ("min(id)", "max(id)", "users"), "score": ("min(score)", "max(score)", "posts"),
        "year": ("min(year(creation_date))", "max(year(creation_date))", "posts"), "post": ("min(id)", "max(id)", "posts"), "kind": ("min(post_type_id)", "max(post_type_id)", "posts"),
        "month": ("min(month(creation_date))", "max(month(creation_date))", "votes"), "vote": ("min(vote_type_id)", "max(vote_type_id)", "votes"),
    }

    def drawn(name, low, high):
        return f"{low} + CAST('0x' || substr(md5('7:{name}:' || s_suppkey), 1, 8) AS BIGINT) % ({high} - {low} + 1) AS v_{name}"

    values = [drawn(n, f"(SELECT {a} FROM {t})", f"(SELECT {b} FROM {t})") for n, (a, b, t) in bounds.items()] + [drawn("few", 2, 6), drawn("n", 5, 60)]
    text = "text"
    for name in [*bounds, "few", "n"]:
        text = f"replace({text}, '{{{name}}}', CAST(v_{name} AS VARCHAR))"
    return f"""{_PIECES}, drawn AS (SELECT s_suppkey AS draw, {", ".join(values)} FROM supplier),
expanded AS (SELECT draw, template, family, draw * many + template AS position, {text} AS query_text FROM drawn, numbered)"""


_add("d30_template_expansion", _expanded, on_stack(f"WITH {_expanded_sql()} SELECT * FROM expanded"))


def _existing(t):
    """Queries already in the table: everything the first half of the draws produced."""
    half = t.supplier.agg(F.avg("s_suppkey")).scalar()
    return _expanded(t).filter(c("draw") < half).select("query_text")


def _fresh(t):
    return P.new_queries(_expanded(t), _existing(t), "position")


_FRESH_SQL = f"""{_expanded_sql()}, existing AS (
  SELECT query_text FROM expanded WHERE draw < (SELECT avg(s_suppkey) FROM supplier)),
fresh AS (
  SELECT query_text, min(position) AS position FROM expanded
  WHERE trim(query_text) NOT IN (SELECT trim(query_text) FROM existing) GROUP BY query_text)"""
_add("d31_new_queries", lambda t: _fresh(t).select("position", "query_text"), on_stack(f"WITH {_FRESH_SQL} SELECT position, query_text FROM fresh"))
_add(
    "d32_continued_ids",
    lambda t: P.continue_ids(_fresh(t), t.orders.select(c("o_orderkey").alias("query_id")), [c("position")]).select("query_id", "query_text"),
    on_stack(f"""WITH {_FRESH_SQL} SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY position) AS query_id,
         query_text FROM fresh"""),
)


def _stratified(t):
    rows = t.measurements.withColumn("key", F.concat_ws(":", c("user_id").cast("string"), "event_type"))
    severity = P.severity(c("execution_time_warm_ms"), c("label"), c("timed_out_runs"), 35.0, 60.0)
    return P.sample_per_stratum(rows, severity, "key", 11, 8).select("key", "stratum")


_add(
    "d33_sample_by_severity",
    _stratified,
    f"""WITH {X.SQL_MEASUREMENTS}, s AS (SELECT user_id || ':' || event_type AS key, CASE WHEN label <> 'slow' OR timed_out_runs <> 0 THEN NULL
           WHEN execution_time_warm_ms >= 60 THEN 'severe' WHEN execution_time_warm_ms >= 35 THEN 'moderate' END AS stratum FROM measurements)
       SELECT key, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('11:' || key), key) AS n FROM s WHERE stratum IS NOT NULL)
       WHERE n <= 8""",
)
_add(
    "d33_spot_check_sample",
    lambda t: P.spot_check_sample(
        t.measurements.withColumn("key", F.concat_ws(":", c("user_id").cast("string"), "event_type")), "key", 7, 20
    ).select("key", "label"),
    f"""WITH {X.SQL_MEASUREMENTS}, s AS (SELECT user_id || ':' || event_type AS key, label FROM measurements)
       SELECT key, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('7:' || key), key) AS n FROM s) WHERE n <= 10""",
)

# ---- scores of predicted rewrites


def _predictions(t):
    """Candidates as predictions; the text they should equal comes from the first half of the users only."""
    half = t.stats.agg(F.avg("user_id")).scalar()
    return t.candidates.withColumns(
        {
            "split": F.when(c("user_id") < half, "train").otherwise("val"),
            "expected": F.when(c("user_id") < half, F.concat(F.lit(" "), F.upper("sql"))).otherwise(c("query")),
        }
    )


_PRED_SQL = f"""{X.SQL_CANDIDATES}, predicted AS (
  SELECT c.*, CASE WHEN user_id < (SELECT avg(user_id) FROM stats) THEN 'train' ELSE 'val' END AS split,
         user_id < (SELECT avg(user_id) FROM stats) AS first_half FROM candidates c JOIN stats USING (stmt))"""


def _rates_sql(flags: dict[str, str]) -> str:
    cols = ", ".join(f"round(100.0 * count(*) FILTER ({e}) / count(*), 4) AS {k}" for k, e in flags.items())
    return f"WITH {_PRED_SQL} SELECT split, count(*) AS n, {cols} FROM predicted GROUP BY split UNION ALL SELECT 'overall', count(*), {cols} FROM predicted"


_OPT_SQL = {
    "removed_select_star": "contains(upper(query), 'SELECT *') AND NOT contains(upper(sql), 'SELECT *')",
    "added_limit": "NOT contains(upper(query), 'LIMIT') AND contains(upper(sql), 'LIMIT')",
    "added_where": "NOT contains(upper(query), 'WHERE') AND contains(upper(sql), 'WHERE')",
    "reduced_joins": f"{X.sql_count('upper(query)', 'JOIN')} > {X.sql_count('upper(sql)', 'JOIN')}",
    "used_ilike": "contains(upper(query), 'LIKE') AND contains(upper(sql), 'ILIKE')",
}
_OPT_SQL["any_optimization"] = " OR ".join(f"({e})" for e in _OPT_SQL.values())


def _rates(t, flags):
    out = R.rates(_predictions(t), "split", flags)
    return out.select("split", "n", *[r4(c(k), k) for k in flags])


_add("d34_optimisation_rates", lambda t: _rates(t, T.optimisation_flags(c("query"), c("sql"))), _rates_sql(_OPT_SQL))
_add("d35_exact_match", lambda t: _rates(t, {"exact_match": R.exact_match(c("sql"), c("expected"))}), _rates_sql({"exact_match": "first_half"}))
_add(
    "d36_valid_sql",
    lambda t: _rates(t, {"valid_sql": T.is_candidate(F.concat(c("sql"), F.lit(" ")))}),
    _rates_sql({"valid_sql": "sql ILIKE 'SELECT%' AND sql ILIKE '%FROM%'"}),
)


def _bleu_rows(t):
    split = F.when(F.length("slow") > 250, "val").otherwise("train")
    return t.pairs.withColumn("split", split)


_TOKENS = """list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    ' ' || replace(replace(replace(replace(replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '), '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
    '([\\{{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])', ' \\1 ', 'g'), '([^0-9])([\\.,])', '\\1 \\2 ', 'g'), '([\\.,])([^0-9])', ' \\1 \\2', 'g'), '([0-9])(-)', '\\1 \\2 ', 'g'), '\\s+'), lambda t: t <> '')"""
_GRAMS = """{side} AS (SELECT pair_id, split, n, array_to_string(list_slice(toks, i, i + n - 1), ' ') AS gram, count(*) AS k
  FROM (SELECT pair_id, split, toks, n, unnest(generate_series(1, len(toks) - n + 1)) AS i
        FROM (SELECT pair_id, split, {tokens} AS toks FROM labelled), (SELECT unnest([1, 2, 3, 4]) AS n))
  GROUP BY ALL)"""
_add(
    "d37_corpus_bleu",
    lambda t: P.corpus_bleu(_bleu_rows(t), "pair_id", "optimized", "slow", "split").withColumn("bleu", F.round("bleu", 6)),
    f"""WITH {X.SQL_PAIRS}, labelled AS (SELECT *, CASE WHEN length(slow) > 250 THEN 'val' ELSE 'train' END AS split FROM pairs),
{_GRAMS.format(side="hyp", tokens=_TOKENS.format(x="optimized"))}, {_GRAMS.format(side="ref", tokens=_TOKENS.format(x="slow"))},
per AS (SELECT h.split, h.n, sum(least(h.k, coalesce(r.k, 0))) AS c, sum(h.k) AS t
        FROM hyp h LEFT JOIN ref r USING (pair_id, n, gram) GROUP BY h.split, h.n),
lens AS (SELECT split, sum(k) AS r FROM ref WHERE n = 1 GROUP BY split),
logs AS (SELECT per.split, avg(ln(CASE WHEN c > 0 THEN c / t ELSE 1 / (pow(2, z) * t) END)) AS l, max(t) FILTER (n = 1) AS hyp_len
         FROM (SELECT *, count(*) FILTER (c = 0) OVER (PARTITION BY split ORDER BY n) AS z FROM per) per GROUP BY per.split)
SELECT logs.split, round(100 * exp(l) * CASE WHEN hyp_len >= r THEN 1 ELSE exp(1 - r / hyp_len) END, 6) AS bleu FROM logs JOIN lens USING (split)""",
)
