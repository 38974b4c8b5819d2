"""Published results: the input rows are fixed values, the totals are known."""

import pytest

from slowtide.operators import reports as R
from slowtide.sources import files

RUN = [
    ("SELECT * with ORDER BY no LIMIT", "win", 404.4, 1012.0, "add LIMIT", True, 1.0),
    ("correlated subquery COUNT", "win", 197.0, 1.38, "rewrite subquery as JOIN", True, 1.0),
    ("correlated subquery AVG", "win", 400.1, 1.71, "rewrite subquery as JOIN", True, 1.0),
    ("3-table JOIN SELECT *", "win", 3774.2, 7.94, "remove SELECT *", True, 1.0),
    ("LIKE wildcard with OR", "skipped_below_threshold", None, None, None, False, None),
    ("SELECT * ORDER BY unindexed column", "win", 207.3, 5.42, "add LIMIT", True, 0.71),
    ("multiple correlated subqueries", "win", 105.3, 1.24, "rewrite subquery as JOIN", True, 0.78),
    ("DISTINCT with 3-table JOIN", "win", 381.6, 2.31, "add LIMIT", True, 0.88),
]
PERCENTS = [
    (64.4962, 99.9079), (0.1488, -0.7584), (8.9842, 31.2115), (2.3964, 1.6973), (-13.1458, 33.4534), (-17.9379, 0.3334),
    (10.4706, 4.7794), (80.7104, 79.8319), (-13.7469, -20.6129), (-2.964, -1.3151), (-187.9626, -140.5156), (3.0155, 99.4211),
    (8.7074, 4.8157), (81.6702, 90.5738), (4.4308, 6.1608), (-220.0489, 1.02),
]
SPOT = [
    (129.92, 43.6325, 0.099088, "slow"), (34.14, 1.2799, 1.5e-05, "fast"), (167.1, 172.785, 0.997566, "slow"),
    (305.53, 204.6222, 0.999944, "slow"), (0.03, 0.1673, 0.0, "fast"), (220.39, 234.9786, 0.999694, "slow"),
    (0.04, 0.1622, 1e-06, "fast"), (142.52, 202.4475, 0.963338, "slow"), (0.16, 2.7347, 0.004713, "fast"),
    (0.02, 0.1577, 1e-06, "fast"), (0.49, 4.0021, 0.002021, "fast"), (0.02, 0.1727, 1e-06, "fast"),
    (114.29, 75.4834, 0.539805, "slow"), (24.65, 193.345, 0.999859, "fast"), (504.21, 258.2209, 0.999984, "slow"),
    (0.02, 0.1727, 1e-06, "fast"), (330.41, 204.0585, 0.99994, "slow"), (170.65, 250.4869, 0.9999, "slow"),
    (173.62, 119.8309, 0.91821, "slow"), (98.59, 82.0376, 0.500627, "fast"),
]
LOG = [
    (948.77, 1.0, 392.95, 555.822), (4991.71, 1.0, 4466.3, 525.4115), (435.2, 1.0, 434.92, 0.2855), (4991.71, 1.0, 4509.11, 482.6),
    (948.77, 1.0, 386.87, 561.9), (404.81, 1.0, 404.41, 0.4), (709.58, 1.0, 196.98, 512.6), (967.53, 1.0, 400.13, 567.4),
    (4318.31, 1.0, 3774.21, 544.1), (254.24, 0.9998, 207.34, 46.9), (539.83, 1.0, 105.33, 434.5), (672.48, 0.9996, 381.58, 290.9),
    (835.56, 0.9999, 4.46, 831.1),
]


def _run_results(spark):
    names = "pattern string, result string, measured_speedup_ms double, speedup_factor double, strategy string, similar_fix_found boolean, similar_fix_similarity double"
    return spark.createDataFrame(RUN, names)


def test_run_result_summary(spark):
    row = R.run_result_summary(_run_results(spark)).first()
    assert (row.wins, row.attempted, row.skipped, row.total) == (7, 7, 1, 8)
    assert row.total_saved_ms == pytest.approx(5469.9)
    assert row.mean_saved_ms == pytest.approx(781.41, abs=0.01)
    assert row.median_saved_ms == pytest.approx(381.6)
    assert row.mean_factor == pytest.approx(147.43, abs=0.01)
    assert row.mean_similarity == pytest.approx(0.91, abs=0.001)
    assert row.best_pattern == "3-table JOIN SELECT *"
    assert row.similar_found == 7


def test_strategy_breakdown(spark):
    rows = R.strategy_breakdown(_run_results(spark)).collect()
    assert [(r.strategy, r.wins) for r in rows] == [("add LIMIT", 3), ("rewrite subquery as JOIN", 3), ("remove SELECT *", 1)]


def test_approach_summary(spark):
    rows = [(a, False, b, False) for a, b in PERCENTS]
    df = spark.createDataFrame(rows, "one_speedup_pct double, one_broken boolean, full_speedup_pct double, full_broken boolean")
    out = {r.approach: r for r in R.approach_summary(df, ["one", "full"]).collect()}
    assert out["one"].avg_speedup_pct == pytest.approx(-11.9235, abs=1e-3)
    assert out["one"].win_rate_pct == 62.5
    assert out["full"].avg_speedup_pct == pytest.approx(18.1253, abs=1e-3)
    assert out["full"].win_rate_pct == 75.0
    assert out["full"].broken_rate_pct == 0.0


def test_approach_with_broken_rows(spark):
    rows = [(None, True), (10.0, False), (None, False)]
    row = R.approach_summary(spark.createDataFrame(rows, "a_speedup_pct double, a_broken boolean"), ["a"]).first()
    assert row.avg_speedup_pct == 10.0
    assert row.win_rate_pct == 50.0
    assert row.broken_rate_pct == pytest.approx(100 / 3)


def test_spot_check(spark):
    df = spark.createDataFrame(SPOT, "actual_ms double, predicted_ms double, p_slow double, actual_label string")
    row = R.spot_check_summary(R.spot_check(df)).first()
    assert (row.correct, row.n) == (17, 20)
    assert row.log_mae == pytest.approx(0.6097, abs=1e-4)


def test_dashboard(spark):
    rows = [
        {"query": f"q{i}", "pg_stat_mean_ms": m, "model": {"p_slow": p}, "measured_speedup_ms": s, "top_candidate_verified": {"warm_median_ms": w}}
        for i, (m, p, s, w) in enumerate(LOG)
    ]
    log = R.normalise_log(spark.createDataFrame(rows, files.EVENT))
    row = R.dashboard_stats(log).first()
    assert (row.total, row.flagged, row.fixed, row.avg_speedup, row.total_saved_ms) == (13, 13, 13, 1205.0, 15664.0)
    bars = R.before_after(log).collect()
    assert len(bars) == 13
    assert min(b.after_pct for b in bars) == 3.0


def test_dashboard_of_nothing(spark):
    row = R.dashboard_stats(R.normalise_log(spark.createDataFrame([], files.EVENT))).first()
    assert (row.total, row.flagged, row.fixed, row.avg_speedup) == (0, 0, 0, 0.0)


def test_log_shapes(spark):
    rows = [
        {"query": "old", "avg_time_ms": 12.0, "confidence": 80.0, "fix": "f", "speedup_ms": None, "flagged": True},
        {"query": "none", "type": "no_candidates", "p_slow": 0.9},
        {"query": "new", "pg_stat_mean_ms": 50.0, "model": {"p_slow": 0.5}, "measured_speedup_ms": -3.0},
    ]
    out = {r["query"]: r for r in R.normalise_log(spark.createDataFrame(rows, files.EVENT)).collect()}
    assert set(out) == {"old", "new"}
    assert out["old"].speedup_ms == 0 and out["old"].llm_source == "gpt" and out["old"].flagged and not out["old"].measured
    assert out["new"].speedup_ms == 0 and out["new"].flagged and out["new"].confidence == 50.0 and not out["new"].measured
