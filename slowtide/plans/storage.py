"""Sources and sinks: data derived from the test tables is written in each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from slowtide.operators import pairs as P
from slowtide.operators import reports as R
from slowtide.plans import fixtures as X
from slowtide.plans.fixtures import Log
from slowtide.plans.relational import r4
from slowtide.plans.reports import _RUN_RESULTS_SQL, _evaluation, _run_results
from slowtide.plans.stack import on_stack
from slowtide.session import scratch_path
from slowtide.sources import files

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col


def _add(name, build, sql):
    QUERIES[name] = lambda spark, folder: build(Log(spark, folder))
    CHECKS[name] = X.exact_rounding(sql)


def _customer_dump(t):
    """Customers as a user dump: some without reputation, some with one that is no number."""
    path = scratch_path(t.spark, "dump")
    reputation = F.when(c("c_mktsegment") == "MACHINERY", None).when(c("c_mktsegment") == "FURNITURE", "many").otherwise(
        F.floor("c_acctbal").cast("string")
    )
    rows = t.customer.select(
        (c("c_custkey") + 1).alias("Id"),
        c("c_name").alias("DisplayName"),
        F.when(c("c_acctbal") > 0, F.concat(c("c_mktsegment"), F.lit(" & co"))).alias("Location"),
        reputation.alias("Reputation"),
        F.lit("2010-07-19T06:55:26.860").alias("CreationDate"),
    )
    files.write_dump(rows, path, "users")
    return files.read_dump(t.spark, path, "users")


_DUMP_SQL = """dump AS (
  SELECT CAST(c_custkey + 1 AS VARCHAR) AS Id, c_name AS DisplayName, CASE WHEN c_acctbal > 0 THEN c_mktsegment || ' & co' END AS Location,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN 'many' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS Reputation,
         '2010-07-19T06:55:26.860' AS CreationDate FROM customer)"""
_add("s01_xml_dump", _customer_dump, f"WITH {_DUMP_SQL} SELECT * FROM dump")
_add(
    "s02_typed_rows",
    lambda t: files.accepted(files.typed(_customer_dump(t), "users")),
    f"""WITH {_DUMP_SQL} SELECT CAST(Id AS INTEGER) AS id, DisplayName AS display_name, Location AS location,
         CAST(coalesce(Reputation, '0') AS INTEGER) AS reputation, CAST(CreationDate AS TIMESTAMP) AS creation_date
       FROM dump WHERE Reputation IS DISTINCT FROM 'many'""",
)
_add(
    "s02_quarantine",
    lambda t: files.quarantined(files.typed(_customer_dump(t), "users")),
    f"WITH {_DUMP_SQL} SELECT * FROM dump WHERE Reputation = 'many'",
)
_add(
    "s03_missing_defaults",
    lambda t: files.accepted(files.typed(_customer_dump(t), "users")).groupBy("reputation").agg(F.count("*").alias("n"), F.count("location").alias("placed")),
    f"""WITH {_DUMP_SQL} SELECT CAST(coalesce(Reputation, '0') AS INTEGER) AS reputation, count(*) AS n, count(Location) AS placed
       FROM dump WHERE Reputation IS DISTINCT FROM 'many' GROUP BY 1""",
)


def _layout_dump(t):
    """A dump of customers whose elements are indented, share lines or span them, with damaged ones from the regions among them."""
    path = scratch_path(t.spark, "layouts")
    one = F.concat(F.lit('<row Id="'), c("c_custkey"), F.lit('" DisplayName="'), c("c_name"), F.lit('"'))
    shape = c("c_custkey") % 3
    whole = F.when(shape == 0, F.concat(F.lit("\t"), one, F.lit(" />"))).when(shape == 1, F.concat(one, F.lit('/> <row Id="-'), c("c_custkey"), F.lit("\" ></row>"))).otherwise(F.concat(one, F.lit('\n    Location="x > y" />')))
    t.customer.select(whole).write.text(path)
    t.region.select(F.concat(F.lit('<row Id="'), "r_regionkey", F.lit('" DisplayName="'), "r_name", F.lit(" is cut"))).write.mode("append").text(path)
    return path


_add(
    "s01_dump_layouts",
    lambda t: files.read_dump(t.spark, _layout_dump(t), "users").select("Id", "DisplayName", "Location"),
    """SELECT CAST(c_custkey AS VARCHAR) AS Id, c_name AS DisplayName, CASE WHEN c_custkey % 3 = 2 THEN 'x > y' END AS Location FROM customer
       UNION ALL SELECT '-' || c_custkey, NULL, NULL FROM customer WHERE c_custkey % 3 = 1""",
)
_add(
    "s02_rejected_elements",
    lambda t: files.rejected_dump(t.spark, _layout_dump(t), "users"),
    """SELECT '<row Id="' || r_regionkey || '" DisplayName="' || r_name || ' is cut' AS raw FROM region""",
)


def _dump_of(t, table):
    """The derived posts or votes as a dump, read back and typed."""
    path = scratch_path(t.spark, "dump")
    shown = {name: attribute for attribute, name, *_ in files.DUMPS[table]}
    rows = getattr(t, table).withColumn("creation_date", F.date_format("creation_date", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    if table == "votes":  # dump ids are numbers
        rows = rows.withColumn("id", c("post_id") * 10 + c("vote_type_id"))
    files.write_dump(rows.select(*[c(name).cast("string").alias(attribute) for name, attribute in shown.items()]), path, table)
    return files.accepted(files.typed(files.read_dump(t.spark, path, table), table))


_add(
    "s02_typed_posts",
    lambda t: _dump_of(t, "posts"),
    on_stack("SELECT CAST(id AS INTEGER) AS id, post_type_id, CAST(owner_user_id AS INTEGER) AS owner_user_id, title, score, view_count, answer_count, CAST(creation_date AS TIMESTAMP) AS creation_date FROM posts"),
)
_add(
    "s02_typed_votes",
    lambda t: _dump_of(t, "votes"),
    on_stack("SELECT CAST(post_id * 10 + vote_type_id AS INTEGER) AS id, CAST(post_id AS INTEGER) AS post_id, CAST(vote_type_id AS INTEGER) AS vote_type_id, CAST(creation_date AS TIMESTAMP) AS creation_date FROM votes"),
)
_add(
    "s04_insert_if_absent",
    # documents by text: repeated texts are the conflicting keys, benchmark texts are there already
    lambda t: P.insert_absent(t.documents.select("doc_id", "text", "source"), t.benchmark, "text", [c("doc_id")]),
    """SELECT doc_id, text, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents
         WHERE text NOT IN (SELECT text FROM benchmark)) WHERE n = 1""",
)


def _measurement_rows(t):
    rows = t.training
    return rows.withColumn("query_id", c("user_id") * 10 + F.length("event_type"))


def _csv_round_trip(t):
    path = scratch_path(t.spark, "measurements")
    files.append_measurements(_measurement_rows(t), path, "csv")
    return files.read_measurements(t.spark, path)


_MEASURED_SQL = f"""WITH {X.SQL_MEASUREMENTS}, {X.SQL_SCORED}
       SELECT m.user_id * 10 + length(m.event_type) AS query_id, f.query AS query_text, execution_time_cold_ms, execution_time_warm_ms,
         execution_time_warm_std_ms, all_runs_ms, timed_out_runs, label, has_select_star, has_like_wildcard, join_count, has_subquery,
         has_group_by, has_order_by_no_limit, has_or, has_function_in_where, CAST(f.plan_total_cost AS DOUBLE) AS plan_total_cost,
         f.calls AS plan_rows, m.user_id AS actual_rows, 1 AS plan_depth, m.user_id AS shared_hit, f.calls AS shared_read, 1 AS has_seq_scan,
         1 AS has_index_scan, 0 AS has_bitmap_scan, 1 AS has_hash_join, 0 AS has_nested_loop, 0 AS has_merge_join
       FROM measurements m JOIN featured f USING (user_id, event_type)"""
_add("s05_measurement_csv", _csv_round_trip, _MEASURED_SQL)




def _foreign_measurements(t):
    """Measurements of the customers as another program writes them: line breaks inside quoted names; the suppliers' keys are no numbers."""
    path = scratch_path(t.spark, "foreign")
    rest = [F.lit(None).cast("string").alias(f.name) for f in files.MEASUREMENT.fields[3:]]
    line = lambda key, text: [key.cast("string").alias("query_id"), text.alias("query_text"), F.lit("1.5").alias("execution_time_cold_ms"), *rest]
    rows = t.customer.select(*line(c("c_custkey"), F.replace("c_name", F.lit("#"), F.lit('\n"#"\n'))))
    bad = t.supplier.select(*line(F.concat(F.lit("s"), c("s_suppkey")), F.concat(c("s_name"), F.lit("\n;"))))
    rows.unionAll(bad).write.csv(path, header=True, escape='"')
    return path


_add(
    "s05_foreign_csv",
    lambda t: files.read_measurements(t.spark, _foreign_measurements(t)).select("query_id", "query_text", "execution_time_cold_ms"),
    """SELECT c_custkey AS query_id, replace(c_name, '#', chr(10) || '"#"' || chr(10)) AS query_text, CAST(1.5 AS DOUBLE) AS execution_time_cold_ms FROM customer""",
)
_add(
    "s05_rejected_csv",
    lambda t: files.rejected_measurements(t.spark, _foreign_measurements(t)),
    f"""SELECT 's' || s_suppkey || ',"' || s_name || chr(10) || ';",1.5' || repeat(',', {len(files.MEASUREMENT.fields) - 3}) AS raw FROM supplier""",
)


def _appended(t):
    path = scratch_path(t.spark, "appended")
    rows = _measurement_rows(t)
    files.append_measurements(rows.filter("label = 'slow'"), path)
    # other column order, same table
    files.append_measurements(rows.filter("label = 'fast'").select(*reversed(rows.columns)), path)
    return t.spark.read.schema(files.MEASUREMENT).parquet(path)


_add("s06_measurement_append", _appended, _MEASURED_SQL)


def _log_round_trip(t):
    path = scratch_path(t.spark, "log")
    empty = files.read_log(t.spark, path)
    files.append_log(t.log.drop("stmt"), path)
    return empty.unionByName(files.read_log(t.spark, path))


_add(
    "s07_json_log",
    lambda t: R.normalise_log(_log_round_trip(t)).withColumn("avg_time_ms", F.round("avg_time_ms", 6)),
    f"WITH {X.SQL_LOG} SELECT * REPLACE (round(avg_time_ms, 6) AS avg_time_ms) FROM log",
)


def _damaged_log(t):
    """A log among whose records lie cut-off ones, one for each region."""
    path = scratch_path(t.spark, "log")
    files.append_log(t.log.drop("stmt"), path)
    t.region.select(F.concat(F.lit('{"type": "slow_query_handled", "query": "'), "r_name")).write.mode("append").text(path)
    return path


_add(
    "s07_rejected_records",
    lambda t: files.rejected_log(t.spark, _damaged_log(t)),
    """SELECT '{"type": "slow_query_handled", "query": "' || r_name AS raw FROM region""",
)
_add(
    "s07_damaged_log",
    lambda t: files.read_log(t.spark, _damaged_log(t)).agg(F.count("*").alias("n"), F.count("query").alias("n_queries")),
    f"WITH {X.SQL_SCORED} SELECT count(*) AS n, count(query) AS n_queries FROM scored",
)


def _two_appends(t):
    path = scratch_path(t.spark, "events")
    old = c("pg_stat_mean_ms").isNull()
    log = t.log.drop("stmt")
    files.append_log(log.filter(old), path)
    files.append_log(log.filter(~old), path)
    return R.dashboard_stats(R.normalise_log(files.read_log(t.spark, path)))


_add(
    "s08_append_events",
    _two_appends,
    f"""WITH {X.SQL_LOG} SELECT count(*) AS total, count(*) FILTER (flagged) AS flagged, count(*) FILTER (speedup_ms > 0) AS fixed,
         round_even(avg(speedup_ms) FILTER (speedup_ms > 0), 1) AS avg_speedup,
         round_even(sum(speedup_ms) FILTER (speedup_ms > 0), 0) AS total_saved_ms FROM log""",
)


def _history(t):
    path = scratch_path(t.spark, "history")
    entries = t.embeddings.select(
        c("vec_id").alias("entry_id"), F.concat(F.lit("query "), c("label").cast("string")).alias("slow_query"),
        F.lit("fix").alias("fix"), c("label").cast("double").alias("speedup_ms"), c("embedding").alias("vector"),
    )
    files.append_history(entries, path)
    return files.read_history(t.spark, path).select(
        "entry_id", "slow_query", "speedup_ms", F.array_size("vector").cast("bigint").alias("width"),
        r4(F.aggregate(F.transform("vector", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x), "total"),
    )


_add(
    "s09_history_table",
    _history,
    """SELECT vec_id AS entry_id, 'query ' || label AS slow_query, CAST(label AS DOUBLE) AS speedup_ms, len(embedding) AS width,
         round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings""",
)


def _pairs(t):
    path = scratch_path(t.spark, "pairs")
    files.write_pairs(t.pairs, path)
    return files.read_pairs(t.spark, path)


_add("s10_pair_set", _pairs, f"WITH {X.SQL_PAIRS} SELECT slow, optimized FROM pairs")


def _results(t):
    path = scratch_path(t.spark, "results")
    _run_results(t).write.json(path)
    return R.strategy_breakdown(files.read_run_results(t.spark, path, lines=True))


_add(
    "s12_run_results",
    _results,
    f"WITH {_RUN_RESULTS_SQL} SELECT strategy, count(*) AS wins FROM results WHERE result = 'win' GROUP BY strategy",
)


def _evaluation_files(t):
    path = scratch_path(t.spark, "evaluation")
    rows = _evaluation(t)
    files.write_evaluation(rows, R.approach_summary(rows, ["simple", "full"]), path)
    kinds = "simple_speedup_pct double, simple_broken boolean, full_speedup_pct double, full_broken boolean"
    back = t.spark.read.schema(kinds).csv(f"{path}/rows", header=True, escape='"')
    summary = t.spark.read.schema("approach string, win_rate_pct double").json(f"{path}/summary")
    sizes = back.agg(F.count("*")).scalar()
    return summary.select("approach", r4(c("win_rate_pct"), "win_rate_pct"), sizes.alias("n_rows"))


_add(
    "s13_evaluation_files",
    _evaluation_files,
    """SELECT 'simple' AS approach, round(100.0 * count(*) FILTER (o_orderstatus <> 'P' AND o_totalprice > 250000) / count(*) FILTER (o_orderstatus <> 'P'), 4) AS win_rate_pct,
         count(*) AS n_rows FROM orders
       UNION ALL SELECT 'full', round(100.0 * count(*) FILTER (o_totalprice * 0.1 > 5000) / count(*), 4), count(*) FROM orders""",
)
