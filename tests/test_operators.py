"""Operators on hand-made rows: ties, nulls, hot keys, empty input; answers by brute force."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from slowtide.functions import numeric as N
from slowtide.functions import text as T
from slowtide.functions.plantree import plan_features
from slowtide.functions.scorer import Scorer
from slowtide.operators import candidates as C
from slowtide.operators import joins as J
from slowtide.operators import metrics, models, ordered, pairs, perceptron, runs, templates, vectors, windows

c = F.col


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Small inputs would otherwise be merged into one slice, and nothing would cross slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, most of them of one key, with ties, and some without a key."""
    rnd = random.Random(1)
    rows = [
        (i, None if i % 50 == 0 else 0 if i % 3 else rnd.randrange(40), rnd.randrange(60), None if i % 17 == 0 else rnd.randrange(-5, 9))
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "id int, k int, o int, v int").repartition(5).cache()


def _groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


def test_running_sums(hot):
    rows, df = hot
    got = {r.id: (r.n, r.s) for r in ordered.running_sums(df, ["k"], [c("o"), c("id")], {"n": F.lit(1), "s": c("v")}).collect()}
    want = {}
    for group in _groups(rows).values():
        n, s, seen = 0, 0, False
        for r in group:
            n += 1
            if r[3] is not None:
                s, seen = s + r[3], True
            want[r[0]] = (n, s if seen else None)
    assert got == want


def test_slices_are_crossed(hot):
    _, df = hot
    cut = ordered._cut(df, ["k"], [c("o"), c("id")])
    assert cut.filter("k = 0").select(ordered.SLICE).distinct().count() > 2


def test_positions_without_keys(hot):
    rows, df = hot
    got = {r.id: r.p for r in ordered.positions(df, [], [c("o").desc(), c("id")], "p").collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert got == want


def test_previous(hot):
    rows, df = hot
    got = {r.id: r.b for r in ordered.previous(df, ["k"], ["o", "id"], "v", "b").collect()}
    want = {}
    for group in _groups(rows).values():
        for before, r in zip([None, *group], group):
            want[r[0]] = before[3] if before else None
    assert got == want


@pytest.mark.parametrize("n", [2, 3, 7])
def test_ntile_few_rows(spark, n):
    df = spark.range(5).select(c("id"))
    got = sorted((r.id, r.t) for r in ordered.ntile(df, [c("id")], n, "t").collect())
    sizes = Counter(t for _, t in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert [t for _, t in got] == sorted(t for _, t in got)


def test_quantiles(hot):
    rows, df = hot
    got = {r.k: (r.a, r.m) for r in ordered.quantiles(df, ["k"], "v", {"a": 0.1, "m": 0.5}).collect()}
    for key, group in _groups(rows).items():
        values = sorted(r[3] for r in group if r[3] is not None)
        if not values:
            continue
        place = 0.1 * (len(values) - 1)
        low = values[math.floor(place)]
        assert got[key][0] == pytest.approx(low + (values[math.ceil(place)] - low) * (place - math.floor(place)))
        assert got[key][1] == pytest.approx(statistics.median(values))


def test_rank_at_most(hot):
    rows, df = hot
    for k in (1, 10, 200, 5000):
        got = {r.id: r.r for r in ordered.rank_at_most(df.filter("v is not null"), "v", k, "r").collect()}
        values = [r[3] for r in rows if r[3] is not None]
        want = {r[0]: 1 + sum(v > r[3] for v in values) for r in rows if r[3] is not None}
        assert got == {i: n for i, n in want.items() if n <= k}


def test_running_total_shares_peers(hot):
    rows, df = hot
    got = {r.id: r.t for r in windows.running_total(df, "k", "o", "v", "t").collect()}
    want = {}
    for r in rows:
        values = [x[3] for x in rows if x[1] == r[1] and x[2] <= r[2] and x[3] is not None]
        want[r[0]] = sum(values) if values else None
    assert got == want


@pytest.mark.parametrize("limit", [1, 7, 100, 4000])
def test_first_pairs(spark, limit):
    rnd = random.Random(limit)
    rows = [(i, 0 if i % 2 else rnd.randrange(9), rnd.randrange(10)) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, k int, s int")
    got = J.first_pairs(df, "k", "id", c("s") > 3, {"a": "first.id", "b": "second.id"}, limit).collect()
    want = sorted((x[0], y[0]) for x in rows for y in rows if x[1] == y[1] and x[0] < y[0] and x[2] > 3)[:limit]
    assert sorted((r.a, r.b) for r in got) == want


def test_first_pairs_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, 5)], "id int, k int, s int")
    assert J.first_pairs(df, "k", "id", c("s") > 3, {"a": "first.id"}, 5).count() == 0


def test_null_keys_do_not_match(spark):
    left = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    right = spark.createDataFrame([(None,), (5,)], "k2 int")
    assert [r.id for r in J.having_match(left, "k", right, "k2").collect()] == [2]
    assert [r.id for r in J.lacking_match(left, "k", right, "k2").collect()] == [1]


# ---- runs


def test_run_summary(spark):
    rows = [("a", 3, 50.0), ("a", 1, 900.0), ("a", 2, 40.0), ("a", 4, 12000.0), ("b", 1, 7.0), ("c", 1, 5.0), ("c", 2, 6.0), (None, 1, 8.0), (None, 2, 9.0)]
    df = spark.createDataFrame(rows, "q string, at int, ms double")
    got = {r.q: r for r in runs.run_summary(df, ["q"], ["at"], "ms").collect()}
    assert (got["a"].cold_ms, got["a"].warm_ms, got["a"].n_runs, got["a"].timed_out_runs) == (900.0, 50.0, 4, 1)
    assert got["a"].warm_std_ms == pytest.approx(statistics.pstdev([50.0, 40.0, 10000.0]))
    assert (got["b"].warm_ms, got["b"].warm_std_ms) == (7.0, 0.0)
    assert (got["c"].cold_ms, got["c"].warm_ms, got["c"].warm_std_ms) == (5.0, 6.0, 0.0)
    assert (got[None].cold_ms, got[None].warm_ms) == (8.0, 9.0)


@pytest.mark.parametrize(
    ("cold", "kept"), [(10.0, 6), (500.0, 6), (500.01, 3), (2000.0, 3), (2000.01, 2), (10000.0, 2), (20000.0, 2)]
)
def test_run_count_follows_cold_time(spark, cold, kept):
    df = spark.createDataFrame([("a", 0, cold)] + [("a", i, float(i)) for i in range(1, 10)], "q string, at int, ms double")
    row = runs.measurements(df, ["q"], ["at"], "ms").first()
    assert len(row.all_runs_ms.split(";")) == kept
    assert row.execution_time_warm_ms == statistics.median(range(1, kept))
    assert row.timed_out_runs == (1 if cold >= 10000 else 0)


def test_measurement_of_one_run(spark):
    row = runs.measurements(spark.createDataFrame([("a", 0, 150.0)], "q string, at int, ms double"), ["q"], ["at"], "ms").first()
    assert (row.execution_time_warm_ms, row.execution_time_warm_std_ms, row.label, row.all_runs_ms) == (150.0, 0.0, "slow", "150.00")


def test_slow_label_is_strict(spark):
    df = spark.createDataFrame([(100.0,), (100.01,)], "ms double").select(runs.slow_label(c("ms")).alias("l"))
    assert [r.l for r in df.collect()] == ["fast", "slow"]


def test_slow_statements(spark):
    rows = [
        ("select 1 from a", 500.0, 1), ("SELECT x OFFSET 3", 900.0, 1), ("EXPLAIN SELECT 1", 900.0, 1), ("UPDATE t", 900.0, 1),
        ("SELECT * FROM pg_stat_statements", 900.0, 1), ("SELECT fast", 100.0, 1), ("SELECT b", 101.0, 1),
    ]
    df = spark.createDataFrame(rows, "query string, mean_exec_time double, calls bigint")
    assert [r.query for r in runs.slow_statements(df).collect()] == ["select 1 from a", "SELECT b"]


# ---- text


def _python_features(q):
    up = q.upper()
    return {
        "has_select_star": int("SELECT *" in up), "has_like_wildcard": int("LIKE '%" in up), "join_count": up.count("JOIN"),
        "has_subquery": int(up.count("SELECT") > 1), "has_group_by": int("GROUP BY" in up),
        "has_order_by_no_limit": int("ORDER BY" in up and "LIMIT" not in up), "has_or": int(" OR " in up),
        "has_function_in_where": int(any(f in up for f in ("LOWER(", "UPPER(", "EXTRACT(", "LENGTH("))),
    }


def test_text_features(spark):
    texts = [t for _, t in templates.TEMPLATES] + ["", "select * from t where a ilike '%x' or b", "JOINJOIN joinJOI", "select lower (x)"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    for row in df.select("q", *[v.alias(k) for k, v in T.text_features(c("q")).items()]).collect():
        want = _python_features(row.q)
        assert {k: row[k] for k in want} == want


def test_answers(spark):
    cases = [
        ("### Slow\nx\n### Optimized Query\nSELECT a FROM t;\nSELECT b FROM u;", "SELECT a FROM t"),
        ("```sql\nselect a\nfrom t\n```", "select a\nfrom t"),
        ("SELECT a FROM t OFFSET 0 LIMIT 3", "SELECT a FROM t"),
        ("SELECT ';' AS x, b FROM t;", "SELECT ';' AS x, b FROM t"),
        ("SELECT a FROM t LEFT joins u;;", "SELECT a FROM t LEFT JOIN u"),
        ("  \n SELECT 1", None),
        ("WITH x AS (SELECT 1) SELECT * FROM x", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "i int, r string")
    got = {x.i: x.s for x in df.select("i", T.clean_candidate(T.answer_sql(c("r"))).alias("s")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_strategies(spark):
    cases = [
        ("SELECT * FROM a", "SELECT x FROM a LIMIT 5", T.DROP_STAR),
        ("SELECT (SELECT 1) FROM a", "SELECT 1 FROM a JOIN b GROUP BY x", T.TO_JOIN),
        ("SELECT (SELECT 1) FROM a", "SELECT 1 FROM a", T.TO_JOIN),
        ("SELECT x FROM a JOIN b", "SELECT x FROM a", T.FEWER_JOINS),
        ("SELECT x FROM a", "SELECT x FROM a WHERE y LIMIT 3", T.ADD_WHERE),
        ("SELECT x FROM a", "SELECT x FROM a LIMIT 3", T.ADD_LIMIT),
        ("SELECT x FROM a", "SELECT x FROM a ", T.OTHER),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r.s for r in df.select("i", T.strategy(c("a"), c("b")).alias("s")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for *_, w in cases]


def test_clean_pairs(spark):
    rows = [("a &acute;b", "SELECT u.99 FROM üsers "), ("x", "DELETE FROM y"), ("same", "SELECT a FROM b")]
    out = pairs.clean_pairs(spark.createDataFrame(rows, "slow string, optimized string"))
    assert sorted((r.slow, r.optimized, r.changed, r.kept) for r in out.collect()) == [
        ("a b", "SELECT u.id FROM sers", True, True), ("same", "SELECT a FROM b", False, True), ("x", "DELETE FROM y", False, False),
    ]
    row = pairs.cleaning_report(out).first()
    assert (row.before, row.fixed, row.removed, row.after) == (3, 1, 1, 2)


# ---- candidates


def test_candidates_dedup_order_and_limit(spark):
    answers = [("s", "SELECT * FROM q", i, t) for i, t in enumerate(["SELECT b FROM t;", "bad", "SELECT b FROM t", "SELECT a FROM t", "SELECT c FROM t", "SELECT d FROM t"])]
    out = C.extract_candidates(spark.createDataFrame(answers, "stmt string, query string, position int, raw string"), "stmt", "position")
    assert sorted((r.position, r.sql) for r in out.collect()) == [(0, "SELECT b FROM t"), (3, "SELECT a FROM t"), (4, "SELECT c FROM t")]


def test_rank_keeps_order_on_ties_and_gate_includes_edge(spark):
    rows = [("s", i, f"q{i}", p, 100.0) for i, p in enumerate([30.0, 10.0, 30.0])]
    out = C.rank_candidates(spark.createDataFrame(rows, "stmt string, position int, sql string, predicted_ms double, mean double"), "stmt", "position", "mean")
    assert [r.sql for r in out.orderBy("rank").collect()] == ["q1", "q0", "q2"]
    scored = spark.createDataFrame([(0.5,), (0.4999,)], "p_slow double")
    assert C.gate(scored).count() == 1


def test_verify_only_promising(spark):
    ranked = spark.createDataFrame(
        [("a", "qa", 100.0, 60.0, 1), ("b", "qb", 100.0, -5.0, 1), ("a", "qz", 100.0, 5.0, 2)],
        "stmt string, sql string, mean double, predicted_speedup_ms double, rank int",
    ).withColumn("query", c("stmt"))
    measured = spark.createDataFrame(
        [("a", "qa", 55.25, 40.04, [1.0]), ("b", "qb", 1.0, 1.0, [1.0])], "stmt string, sql string, cold_ms double, warm_ms double, all_runs_ms array<double>"
    )
    out = C.verify(ranked, measured, "stmt", "mean")
    got = {r.stmt: (r.verified_cold_ms, r.verified_warm_ms, r.measured_speedup_ms) for r in out.collect()}
    assert got == {"a": (55.2, 40.0, 60.0), "b": (None, None, None)}
    assert [(r.slow_query, r.fix, r.speedup_ms) for r in C.wins(out).collect()] == [("a", "qa", 60.0)]


def test_verify_of_a_shared_rewrite(spark):
    ranked = spark.createDataFrame([("a", "qa", 100.0, 60.0, 1, "s"), ("b", "qb", 100.0, 60.0, 1, "s")], "stmt string, query string, base double, predicted_speedup_ms double, rank int, sql string")
    measured = spark.createDataFrame([("a", "s", 1.0, 2.0, [1.0, 2.0]), ("b", "s", 3.0, 4.0, [3.0])], "stmt string, sql string, cold_ms double, warm_ms double, all_runs_ms array<double>")
    got = {r.stmt: (r.verified_warm_ms, r.all_runs_ms) for r in C.verify(ranked, measured, "stmt", "base").collect()}
    assert got == {"a": (2.0, [1.0, 2.0]), "b": (4.0, [3.0])} and C.verify(ranked, measured, "stmt", "base").count() == 2


def test_nulls_come_last_in_lag_and_first_among_leaders(spark):
    df = spark.createDataFrame([("k", 1, None, 10), ("k", 2, 5, 20), ("k", 3, 4, None), ("j", 4, None, 7)], "k string, id int, at int, score int")
    lag = {r.id: r.before for r in ordered.previous(df, ["k"], ["at", "id"], "score", "before").collect()}
    assert lag == {3: None, 2: None, 1: 20, 4: None}
    lead = {r.id: r.best for r in windows.leader(df, "k", "score", "id", "id", "best").collect()}
    assert lead == {1: 3, 2: 3, 3: 3, 4: 4}
    named = df.withColumn("name", F.concat(F.lit("n"), c("id").cast("string"))).withColumn("score", F.lit(1))
    assert {r.best for r in windows.leader(named.filter("k = 'k'"), "k", "score", "name", "name", "best").collect()} == {"n1"}


def test_repeated_lookup_ids_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "lookup_id bigint, vector array<double>")
    history = spark.createDataFrame([(1, [1.0, 0.0])], "entry_id bigint, vector array<double>")
    with pytest.raises(ValueError):
        vectors.similar_fixes(rows, history)


def test_unreadable_plans_are_told_apart(spark):
    from slowtide.functions.plantree import plan_rejected

    deep = '{"Plans": [' * 600 + "{}" + "]}" * 600
    df = spark.createDataFrame([('{"Plan": {}}',), ("{cut",), (None,), (deep,)], "d string").coalesce(1)
    assert [r[0] for r in df.select(plan_rejected(c("d"))).collect()] == [False, True, False, False]


def test_grid_keeps_large_integers(spark):
    from slowtide.operators.aggregates import aggregate_grid

    users = spark.createDataFrame([(1, "x", "n", 1)], "id int, location string, display_name string, reputation int")
    posts = spark.createDataFrame([(1, 1, 1, 2**53), (2, 1, 1, 1)], "id int, owner_user_id int, post_type_id int, score long")
    votes = spark.createDataFrame([(1, 1), (2, 2)], "id int, post_id int")
    got = aggregate_grid(users, posts, votes, ["SUM", "AVG", "COUNT"], ["score"], ["u_location", "post_type_id"]).collect()
    assert {(r.key_name, r.key_value, r.function): r.whole for r in got if r.function != "AVG"} == {
        (k, v, f): n for k, v in (("u_location", "x"), ("post_type_id", "1")) for f, n in (("SUM", 2**53 + 1), ("COUNT", 2))
    }


def test_scratch_is_removed(spark):
    import os

    from slowtide import session

    frame = session.materialize(spark.range(3), "three")
    path = session._written[spark.sparkContext.applicationId][-1].removeprefix("file:")
    assert frame.count() == 3 and os.path.isdir(path)
    kept = session._written[spark.sparkContext.applicationId][:-1]
    session._written[spark.sparkContext.applicationId] = [path]
    session.remove_scratch(spark)
    session._written[spark.sparkContext.applicationId] = kept
    assert not os.path.exists(path)


def test_same_rows(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(2, "x"), (1, None), (1, None)], "i int, s string")
    assert C.same_rows(a, b).first().equal
    assert not C.same_rows(a, b.distinct()).first().equal
    assert C.same_rows(a.limit(0), b.limit(0)).first().equal


# ---- numbers and plans


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_half_even_is_python_round(spark, values):
    values = values + [round(v, 2) + 0.005 for v in values] + [2.675, 0.125, -0.125, 40.855, 1.005]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (1, 2, 4):
        for r in df.select("v", N.half_even(c("v"), digits).alias("r")).collect():
            assert r.r == round(r.v, digits)


def test_half_even_of_null(spark):
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS v").select(N.half_even(c("v"), 2).alias("r")).first().r is None


def test_cosine_of_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert df.select(N.cosine(c("a"), c("b")).alias("s")).first().s is None


def test_plan_features(spark):
    deep = '{"Node Type":"Limit","Shared Hit Blocks":1,"Plans":[' * 40 + '{"Node Type":"Bitmap Heap Scan"}' + "]}" * 40
    cases = {
        None: (0, 0, 0, 0),
        "nonsense": (0, 0, 0, 0),
        "[]": (0, 0, 0, 0),
        '[{"Plan": {"Node Type": "Seq Scan", "Total Cost": 12.5, "Shared Hit Blocks": 3}}]': (0, 3, 1, 0),
        deep: (40, 40, 0, 1),
        '{"Node Type":"Bitmap Index Scan","Plans":[{"Plans":[{"Node Type":"Seq Scan","Shared Hit Blocks":2}]},{"Shared Hit Blocks":4}]}': (2, 6, 1, 1),
    }
    df = spark.createDataFrame([(d,) for d in cases], "d string").select("d", plan_features(c("d")).alias("p"))
    for r in df.collect():
        assert (r.p.plan_depth, r.p.shared_hit, r.p.has_seq_scan, r.p.has_bitmap_scan) == cases[r.d]


def test_plans_of_any_depth(spark):
    from slowtide.functions import plantree

    deep = '{"Node Type":"Limit","Shared Hit Blocks":1,"Total Cost":"7.5","Plans":[' * 5000 + '{"Node Type":"Seq Scan","Shared Read Blocks":2}' + "]}" * 5000
    df = spark.createDataFrame([(f'{{"Plan": {deep}}}',), (deep[:-1],)], "d string").coalesce(1)
    whole, cut = df.select(plan_features(c("d")).alias("p"), plantree.plan_rejected(c("d")).alias("bad")).collect()
    assert (whole.p.plan_depth, whole.p.shared_hit, whole.p.shared_read, whole.p.has_seq_scan, whole.p.plan_total_cost, whole.bad) == (5000, 5000, 2, 1, 7.5, False)
    assert cut.bad and cut.p.plan_depth == 0


def test_token_parser_agrees_with_the_library():
    import json

    from slowtide.functions.plantree import _parse_deep

    rnd = random.Random(7)

    def value(depth):
        kind = rnd.randrange(7 if depth else 5)
        if kind > 4:
            return [value(depth - 1) for _ in range(rnd.randrange(4))] if kind == 5 else {rnd.choice(["a", 'b"', "ü\\"]): value(depth - 1) for _ in range(rnd.randrange(4))}
        return rnd.choice([1, -2.5, 1e30, "x\n\"y", "", None, True, False, 12345678901234567890])

    for _ in range(300):
        v = value(4)
        assert _parse_deep(json.dumps(v, indent=rnd.choice([None, 1]))) == v
        text = list(json.dumps(v))
        text[rnd.randrange(len(text))] = rnd.choice('{}[],:"x1 ')
        text = "".join(text)
        try:
            want = json.loads(text)
        except ValueError:
            with pytest.raises(ValueError):
                _parse_deep(text)
        else:
            assert _parse_deep(text) == want


# ---- preparation


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in range(103)], "id int, s string")
    whole = pairs.split_rows(df, "id", 3, 0.1)
    assert whole.filter("split = 'val'").count() == 10
    assert sorted(whole.filter("split = 'val'").select("id").collect()) == sorted(
        pairs.split_rows(df.repartition(7), "id", 3, 0.1).filter("split = 'val'").select("id").collect()
    )
    by = {(r.s, r.split): r["count"] for r in pairs.split_rows(df, "id", 3, 0.2, strata="s").groupBy("s", "split").count().collect()}
    assert by[("a", "val")] == 16 and by[("b", "val")] == 4


def test_spot_check_sample_fills_up_with_fast(spark):
    df = spark.createDataFrame([(i, "slow" if i < 4 else "fast") for i in range(100)], "id int, label string")
    got = Counter(r.label for r in pairs.spot_check_sample(df, "id", 7, 20).collect())
    assert got == {"slow": 4, "fast": 16}


def test_new_queries_and_ids(spark):
    generated = spark.createDataFrame([(0, " a "), (1, "b"), (2, "a"), (3, "c")], "position int, query_text string")
    existing = spark.createDataFrame([(41, "c "), (12, "z")], "query_id bigint, query_text string")
    fresh = pairs.new_queries(generated, existing, "position")
    assert sorted((r.position, r.query_text) for r in fresh.collect()) == [(0, " a "), (1, "b")]
    ids = pairs.continue_ids(fresh, existing, [c("position")])
    assert sorted((r.query_id, r.position) for r in ids.collect()) == [(42, 0), (43, 1)]
    first = pairs.continue_ids(fresh, existing.limit(0), [c("position")])
    assert min(r.query_id for r in first.collect()) == 1


def _bleu(rows):
    hits, totals, p_len, r_len = [0] * 4, [0] * 4, 0, 0
    for p, r in rows:
        p, r = p.split(), r.split()
        p_len, r_len = p_len + len(p), r_len + len(r)
        for n in range(1, 5):
            a = Counter(tuple(p[i : i + n]) for i in range(len(p) - n + 1))
            b = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
            hits[n - 1] += sum(min(k, b[g]) for g, k in a.items())
            totals[n - 1] += sum(a.values())
    zeros, logs = 0, 0.0
    for h, t in zip(hits, totals):
        zeros += h == 0
        logs += math.log(h / t if h else 1 / (2**zeros * t))
    return 100 * math.exp(logs / 4) * (1 if p_len >= r_len else math.exp(1 - r_len / p_len))


def test_bleu(spark):
    rnd = random.Random(5)
    rows = [(" ".join(rnd.choices("abcd", k=rnd.randrange(1, 30))), " ".join(rnd.choices("abcd", k=rnd.randrange(1, 30)))) for _ in range(40)]
    df = spark.createDataFrame([(i, "x", p, e) for i, (p, e) in enumerate(rows)], "i int, s string, p string, e string")
    assert pairs.corpus_bleu(df, "i", "p", "e", "s").first().bleu == pytest.approx(_bleu(rows))
    same = df.withColumn("p", c("e"))
    assert pairs.corpus_bleu(same, "i", "p", "e", "s").first().bleu == pytest.approx(100.0)
    none = df.withColumn("p", F.lit("zz yy xx ww vv"))
    assert pairs.corpus_bleu(none, "i", "p", "e", "s").first().bleu == 0.0


def test_tokens(spark):
    df = spark.createDataFrame([("SELECT u.id,COUNT(*) &gt; 1.5 FROM t-\nx 3-4",)], "t string")
    assert df.select(pairs.tokens_13a(c("t")).alias("t")).first().t == [
        "SELECT", "u", ".", "id", ",", "COUNT", "(", "*", ")", ">", "1.5", "FROM", "tx", "3", "-", "4",
    ]



def test_bleu_lists_no_grams(spark):
    """Texts of one key count together wherever batches end; no n-gram is a row."""
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 9)))
    rows = [(i % 7 or None, "x" if i % 7 < 3 else "y", text(), text()) for i in range(40)] + [(9, "y", None, "a b"), (9, "z", "a", None), (8, "e", "", "")]
    want = {}
    for key in {(r[0], r[1]) for r in rows}:
        mine = [r for r in rows if (r[0], r[1]) == key]
        sides = [[Counter(g for r in mine for g in zip(*[(r[s] or "").split()[i:] for i in range(n)])) for n in range(1, 5)] for s in (2, 3)]
        now = [(p & e).total() for p, e in zip(*sides)] + [p.total() for p in sides[0]] + [sides[1][0].total()]
        if any(now):
            want[key[1]] = [a + b for a, b in zip(want.get(key[1], [0] * 9), now)]
    got = {}
    for size in (3, 10000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            df = pairs.corpus_bleu(spark.createDataFrame(rows, "k int, s string, p string, e string"), "k", "p", "e", "s")
            got[size] = {r.s: r.bleu for r in df.collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[3] == got[10000] and set(got[3]) == set(want)
    assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()
    for split, n in want.items():
        zeros, logs = 0, 0.0
        for hit, total in zip(n[:4], n[4:8]):
            zeros += hit == 0
            logs += math.log(hit / total if hit else 1 / (2**zeros * total)) if total else math.nan
        if not math.isnan(logs) and any(n[:4]):
            assert math.isclose(got[3][split], 100 * math.exp(logs / 4) * (1 if n[4] >= n[8] else math.exp(1 - n[8] / n[4])))


# ---- vectors


def test_similar_fixes_against_brute_force(spark):
    rnd = random.Random(2)
    vecs = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(60)]
    vecs[10] = vecs[3]
    vecs[20] = [2 * x for x in vecs[3]]
    vecs[30] = [0.0] * 6
    history = spark.createDataFrame(list(enumerate(vecs[:40])), "entry_id bigint, vector array<double>")
    lookups = spark.createDataFrame([(100 + i, v) for i, v in enumerate([*vecs[35:], vecs[3]])], "lookup_id bigint, vector array<double>")

    def cos(a, b):
        n = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / n, 12) if n else -9

    want = {}
    for i, v in enumerate([*vecs[35:], vecs[3]]):
        best = max(range(40), key=lambda j: (cos(v, vecs[j]), -j))
        want[100 + i] = best if cos(v, vecs[best]) > 0.7 else None
    for rows in (4096, 7):
        for index in (None, vectors.build_index(history, cell=5)):
            got = vectors.with_similar_fix(lookups, history, block_rows=rows, index=index)
            assert {r.lookup_id: r.entry_id for r in got.collect()} == want
    assert vectors.with_similar_fix(lookups, history.limit(0)).filter("entry_id is not null").count() == 0


def _clusters(n, centres, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, 24))
    return middle[rng.integers(0, centres, n)] + 0.1 * rng.normal(size=(n, 24))


@pytest.mark.parametrize("k", [1, 3])
def test_lookup_meets_few_cells_and_loses_nothing(spark, k):
    """Clustered vectors with one crowded direction: exact answers from a small part of all pairs."""
    entries = np.concatenate([_clusters(1500, 40, 1), np.tile(_clusters(1, 1, 2), (700, 1))])
    asked = np.concatenate([_clusters(200, 40, 1), entries[1500:1510] * 3, _clusters(20, 5, 9)])
    history = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(entries)] + [(9000, None), (9001, [0.0] * 24)], "entry_id bigint, vector array<double>")
    lookups = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)] + [(9000, None)], "lookup_id bigint, vector array<double>")
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = np.round(unit(asked) @ unit(entries).T, 12)
    want = {(i, int(j), round(float(sims[i, j]), 10)) for i in range(len(asked)) for j in np.lexsort((np.arange(len(entries)), -sims[i]))[:k] if sims[i, j] > 0.7}
    index = vectors.build_index(history, cell=10)
    for rows in (16384, 50):
        got = {(r.lookup_id, r.entry_id, round(r.similarity, 10)) for r in vectors.similar_fixes(lookups, history, k=k, block_rows=rows, index=index).collect()}
        assert {g[0::2] for g in got} == {w[0::2] for w in want} and (k > 1 or got == want)
    assert vectors.visited_pairs(lookups.filter("vector is not null"), index) < 0.2 * sims.size
    assert index.rows.count() == len(entries)


@pytest.mark.parametrize("cell", [5, 4096])
def test_lookup_parts_do_not_repeat_rows_by_block(spark, cell):
    """Rows meet once for each part and share of `part_rows`, however small the matrix products are."""
    entries = np.concatenate([np.random.default_rng(4).normal(size=(150, 8)), np.ones((50, 8))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(entries)], "id bigint, vector array<float>")
    lookups, history = rows.select(c("id").alias("lookup_id"), "vector"), rows.select(c("id").alias("entry_id"), "vector")
    unit = entries.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 12)
    np.fill_diagonal(sims, -1)
    want = {(i, int(j)) for i in range(200) for j in np.lexsort((np.arange(200), -sims[i]))[:3] if sims[i, j] > 0.2}
    index = vectors.build_index(history, cell=cell)
    for most in (30, vectors.PART):
        got = vectors.similar_fixes(lookups, history, 0.2, 3, True, block_rows=4, index=index, part_rows=most)
        assert {(r.lookup_id, r.entry_id) for r in got.collect()} == want
    first, split = index.parts(vectors.PART)
    assert set(first.tolist()) == {0} and set(split.tolist()) == {1}
    first, split = index.parts(30)
    assert np.bincount(first, index.n / split).max() <= 30 and (first[1:] >= first[:-1]).all()
    units = index.rows.select(c("entry_id").alias("lookup_id"), "unit", F.lit(-1.0).alias("floor"))
    assert vectors._routes(units, index, lambda least, floor: np.ones(least.shape, bool), *index.parts(vectors.PART)).count() == 200


# ---- metrics and models


def test_auc_with_ties(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(2), rnd.randrange(12) / 10) for _ in range(200)]
    got = metrics.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    assert got == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.4)], "y int, p int, s double")
    assert metrics.auc(df, "y", "s").first().auc is None
    assert [r.n for r in metrics.confusion(df, "y", "p").orderBy("actual", "predicted").collect()] == [2, 0, 0, 0]
    slow = metrics.classification_report(df, "y", "p").filter("class = 'slow'").first()
    assert (slow.precision, slow.recall, slow.support) == (0.0, 0.0, 0)


def test_quantiles_of_keys_over_many_slices(spark):
    """A hot key spread over many slices, null keys, nulls and ties among the values, keys of one value."""
    rnd = random.Random(13)
    rows = [("hot", 1, rnd.gauss(0, 100)) for _ in range(3000)] + [("hot", 1, 7.0)] * 500
    rows += [(rnd.choice(["a", "b", None]), rnd.choice([1, None]), float(rnd.randrange(40))) for _ in range(2000)]
    rows += [("one", 1, 5.0), ("void", 1, None), ("a", 1, None)]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    probs = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q": 0.7, "high": 1.0}
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        got = {(r.k, r.j): [r[p] for p in probs] for r in ordered.quantiles(df, ["k", "j"], "v", probs).collect()}
        over_all = ordered.quantiles(df, [], "v", probs).first()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    series = {}
    for k, j, v in rows:
        if v is not None:
            series.setdefault((k, j), []).append(v)
    assert got.keys() == series.keys()
    for key, values in series.items():
        assert got[key] == pytest.approx(list(np.quantile(values, list(probs.values())))), key
    everything = [v for _, _, v in rows if v is not None]
    assert list(over_all) == pytest.approx(list(np.quantile(everything, list(probs.values()))))
    assert list(ordered.quantiles(df.filter("v > 1e9"), [], "v", probs).collect()[0]) == [None] * 5


def test_quantile_without_features(spark):
    values = [math.log1p(i * 3.7) for i in range(101)]
    df = spark.createDataFrame([(v,) for v in values], "y_log double")
    weights, bias = models.fit_quantile(df, [])
    assert weights == [] and bias == pytest.approx(values[70])


def test_quantile_recovers_a_line(spark):
    rnd = random.Random(8)
    rows = [(x, 3 * x + 1 + rnd.choice([-1.0, 0.0, 0.5])) for x in (rnd.random() * 10 for _ in range(400))]
    (w,), b = models.fit_quantile(spark.createDataFrame(rows, "x double, y_log double"), ["x"])
    assert w == pytest.approx(3, abs=0.1)
    assert sum(y <= w * x + b + 1e-9 for x, y in rows) / 400 == pytest.approx(0.7, abs=0.02)


def test_slopes_vanish_at_the_optimum_only(spark):
    rnd = random.Random(11)
    rows = [(rnd.random() * 10, rnd.gauss(0, 1)) for _ in range(500)]
    df = spark.createDataFrame([(x, 2 * x + e) for x, e in rows], "x double, y_log double")
    weights, bias = models.fit_quantile(df, ["x"])
    at, off = (models.quantile_slopes(df, ["x"], w, bias).first() for w in (weights, [weights[0] + 0.3]))
    assert max(at) < 5e-3
    assert max(off) > 0.05
    # a row met exactly may have any slope: the median of three is an optimum, its neighbour is not
    three = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "y_log double")
    assert models.quantile_slopes(three, [], [], 2.0, tau=0.5).first().intercept == 0.0
    assert models.quantile_slopes(three, [], [], 3.0, tau=0.5).first().intercept == pytest.approx(1 / 6)


@pytest.mark.parametrize("slow, fast", [(10, 25), (25, 10), (7, 7), (0, 5), (5, 0)])
def test_balanced_repeats_the_rarer_class(spark, slow, fast):
    df = spark.createDataFrame([(i, 1.0 if i < slow else 0.0) for i in range(slow + fast)], "i int, y_slow double")
    got = models.balanced(df, "y_slow").groupBy("i", "y_slow").count().collect()
    assert len(got) == slow + fast  # no row is lost
    total = {y: sum(r["count"] for r in got if r.y_slow == y) for y in (0.0, 1.0)}
    larger, rare = max(slow, fast), 1.0 if slow <= fast else 0.0
    assert total[1 - rare] == larger
    if min(slow, fast):
        assert larger // min(slow, fast) * min(slow, fast) <= total[rare] <= (larger // min(slow, fast) + 1) * min(slow, fast)


def test_perceptron_takes_unscaled_and_unbalanced_rows(spark):
    rnd = random.Random(12)
    # one row in eleven is slow, at features of very different sizes
    rows = [(1e6 + 1e3 * rnd.random() + (2e3 if i % 11 == 0 else 0), 1e-6 * rnd.random(), float(i % 11 == 0)) for i in range(660)]
    df = spark.createDataFrame(rows, "a double, b double, y_slow double")
    right = models.fit_perceptron(df, ["a", "b"]).transform(df).filter("prediction = y_slow").count()
    assert right == 660


def test_scorer_learns_and_clips(spark):
    rnd = random.Random(9)
    rows = [(float(i % 7), 1.0, float(i % 7 > 3), math.log1p((i % 7) * 40 + rnd.random())) for i in range(350)]
    train = spark.createDataFrame(rows, "a double, flat double, y_slow double, y_log double")
    scorer = models.fit_scorer(train, ["a", "flat"])
    out = train.select("y_slow", scorer.p_slow().alias("p"), scorer.predicted_ms().alias("ms")).collect()
    assert all((r.p > 0.5) == (r.y_slow == 1.0) for r in out)
    wild = Scorer(["a"], [0.0], [1.0], [1.0], 0.0, [100.0], 0.0)
    top = spark.createDataFrame([(5.0,), (-5.0,)], "a double").select(wild.predicted_ms().alias("ms")).collect()
    assert [r.ms for r in top] == [pytest.approx(9995.6, abs=0.1), pytest.approx(-0.632, abs=0.001)]


def test_scorer_is_saved_and_loaded(spark, tmp_path):
    one = Scorer(["a", "b"], [1.0, 2.0], [3.0, 0.1], [0.25, -1e-9], 0.5, [1 / 3, 2.0], -7.0)
    one.save(spark, str(tmp_path / "s"))
    assert Scorer.load(spark, str(tmp_path / "s")) == one


def test_moments_give_weighted_least_squares(spark):
    """One aggregate gives what a solver gives; a constant feature and one that repeats another do no harm."""
    rng = np.random.default_rng(6)
    x, w = rng.normal(1e4, 3, size=(300, 2)), rng.uniform(0.1, 2, 300)
    y = 2 * x[:, 0] - x[:, 1] + 7 + rng.normal(0, 0.1, 300)
    names = ["a", "b", "same", "one"]
    df = spark.createDataFrame([(float(a), float(b), float(2 * a), 1.0, float(k), float(t)) for (a, b), k, t in zip(x, w, y)] , "a double, b double, same double, one double, w double, y double")
    means, scales = models.fit_scale(df, names)
    weights, bias = models._solve(df.agg(*models._moments(names, "y", c("w"), means, scales)).first(), names, means, scales)
    root = np.sqrt(w)[:, None]
    best = np.linalg.lstsq(np.column_stack([x - 1e4, np.ones(300)]) * root, y * root[:, 0], rcond=None)[0]
    with pytest.raises(ValueError):
        models.fit_quantile(df.selectExpr("nullif(a, 0) as a", "if(a > 1e4, null, y) as y_log"), ["a"])
    predicted = bias + np.column_stack([x, 2 * x[:, 0], np.ones(300)]) @ weights
    assert np.allclose(predicted, np.column_stack([x - 1e4, np.ones(300)]) @ best, atol=1e-6)


def test_fits_spread_their_rows(spark):
    one = spark.range(10).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert models.spread(one, 99_000).rdd.getNumPartitions() == 1
    assert models.spread(one, 720_000).rdd.getNumPartitions() == min(8, 3 * cores)
    assert models.spread(one, 90_000_000).rdd.getNumPartitions() == max(90, 3 * cores)
    rows = spark.range(0, 300_000, 1, 1).select((c("id") % 7).cast("double").alias("x"), (c("id") % 7).cast("double").alias("y_log"))
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("squared", "")
    models.fit_squared(rows, ["x"])
    jobs = tracker.getJobIdsForGroup("squared")
    context.setJobGroup("", "")
    stages = [tracker.getStageInfo(i) for j in jobs for i in tracker.getJobInfo(j).stageIds]
    assert max(i.numTasks for i in stages if i) >= 3


def test_perceptron_counts_equal_rows(spark, monkeypatch):
    """A pass reads each different row once; each row weighs alike, and what MLlib refuses is refused."""
    read, mean_loss = [], models.mean_loss
    monkeypatch.setattr(models, "mean_loss", lambda df, *rest: read.append(df.count()) or mean_loss(df, *rest))
    # 0.5 of the rows are slow once the classes count alike; MLlib's means of blocks of 128 rows gave 0.657
    one = spark.createDataFrame([(5.0, 1.0)] * 200 + [(5.0, 0.0)] * 100, "x double, y_slow double")
    (p,) = {r.probability[1] for r in models.fit_perceptron(one, ["x"]).transform(one).collect()}
    assert p == pytest.approx(0.5, abs=1e-3)
    # the share of slow rows at each place, which no linear model gives
    many = spark.range(0, 2_000_000, 1, 4).select((c("id") % 4).cast("int").alias("x"), ((c("id") / 4).cast("bigint") % 10 < F.when((c("id") % 4).isin(1, 2), 8).otherwise(2)).cast("double").alias("y_slow"))
    got = models.fit_perceptron(many, ["x"]).transform(many).groupBy("x").agg(F.min(F.get(vector_to_array("probability"), F.lit(1))).alias("p"), F.max("prediction").alias("y")).collect()
    assert {r.x: (round(r.p, 2), r.y) for r in got} == {0: (0.2, 0.0), 1: (0.8, 1.0), 2: (0.8, 1.0), 3: (0.2, 0.0)}
    assert read == [2, 8]
    few = spark.createDataFrame([(float(i), float(i > 50)) for i in range(100)], "x double, y_slow double")
    models.fit_perceptron(few, ["x"], max_iter=2)
    assert read == [2, 8]
    for bad in ((1.0, None), (1.0, 2.0), (None, 1.0), (math.inf, 0.0), (math.nan, 0.0)):
        rows = spark.createDataFrame([(1.0, 1.0)] * 200 + [(2.0, 0.0)] * 200 + [bad] * 200, "x double, y_slow double")
        with pytest.raises(Exception, match="(?i)must|null|nan"):
            models.fit_perceptron(rows, ["x"])
    assert read == [2, 8]


def test_counted_loss_is_that_of_the_repeated_rows(spark):
    """Loss and gradient over tasks and batches, against each row by itself, differences and MLlib's first value."""
    rng, layers = np.random.default_rng(3), [2, 5, 3, 2]
    x, y, n = rng.normal(3, 2, (40, 2)), rng.integers(0, 2, 40), rng.integers(1, 4, 40)
    weights = rng.normal(0, 1, 2 * 5 + 5 + 5 * 3 + 3 + 3 * 2 + 2)
    df = spark.createDataFrame([(*map(float, a), float(b), float(k)) for a, b, k in zip(x, y, n)], "a double, b double, y double, n double").repartition(3)
    means, factors = np.array([3.0, 2.0]), np.array([0.5, 0.0])
    f = perceptron.mean_loss(df, layers, means, factors)
    value, slope = f(weights)
    single = [perceptron.loss(layers, weights, (a[None] - means) * factors, np.array([b]), np.ones(1)) for a, b, k in zip(x, y, n) for _ in range(k)]
    assert value == pytest.approx(np.mean([v for v, _ in single]))
    assert np.allclose(slope, np.mean([g for _, g in single], axis=0))
    for i in (0, 7, 17, 30, len(weights) - 1):
        step = np.eye(len(weights))[i] * 1e-5
        assert slope[i] == pytest.approx((f(weights + step)[0] - f(weights - step)[0]) / 2e-5, abs=1e-7)
    model = MultilayerPerceptronClassifier(labelCol="y", layers=layers, maxIter=0, initialWeights=Vectors.dense(weights)).fit(models.assemble(df, ["a", "b"]).coalesce(1))
    plain = perceptron.loss(layers, weights, x, y, np.ones(40))[0] / 40
    assert model.summary().objectiveHistory[0] == pytest.approx(plain)


def test_lbfgs_reaches_the_least_value():
    rosenbrock = lambda p: (float((1 - p[0]) ** 2 + 100 * (p[1] - p[0] ** 2) ** 2), np.array([-2 * (1 - p[0]) - 400 * p[0] * (p[1] - p[0] ** 2), 200 * (p[1] - p[0] ** 2)]))
    start = np.array([-1.2, 1.0])
    assert np.allclose(perceptron.minimise(rosenbrock, start, 200, 1e-12), [1, 1], atol=1e-4)
    values = [rosenbrock(perceptron.minimise(rosenbrock, start, k, 1e-12))[0] for k in range(0, 30, 3)]
    assert values == sorted(values, reverse=True) and values[0] == rosenbrock(start)[0]
    flat = lambda p: (1.0, np.zeros(2))
    assert (perceptron.minimise(flat, start, 9, 1e-6) == start).all()
    # a value that is none beyond a place: the search comes back from there
    steep = lambda p: (float(-np.log(1 - p[0]) - 3 * p[0]) if p[0] < 1 else math.nan, np.array([1 / (1 - p[0]) - 3 if p[0] != 1 else math.nan]))
    assert np.allclose(perceptron.minimise(steep, np.zeros(1), 50, 1e-9), [2 / 3], atol=1e-3)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("a", 5.0)] * 3 + [("b", 0.0), ("b", 100.0)], "k string, v double")
    got = sorted((r.k, r.bin, r.n) for r in metrics.log_histogram(df, "k", "v").collect())
    assert got == [("a", 21, 3), ("b", 1, 1), ("b", 40, 1)]
