"""Times the headline queries and prints one JSON line.

Each query runs once cold and `BENCH_WARM` times warm; its figure is the warm median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slowtide.plans import all_queries  # noqa: E402
from slowtide.session import local_session  # noqa: E402

HEADLINES = [
    "o01_full_sort", "o02_top_n", "j01_inner_join", "j02_three_tables", "j05_in_subquery", "j09_not_exists", "j10_self_join_posts",
    "j17_correlated_scalar", "j18_two_correlated", "a03_group_by_one", "a07_count_distinct_by_place", "a09_conditional_count",
    "a13_distinct", "a15_aggregate_grid", "a16_fan_out_totals", "w01_running_total", "w03_ntile", "w05_row_number",
    "w07_rank_filtered", "u03_distinct_union", "o06_order_by_expression", "p07_point_lookup", "d01_text_features",
    "d03_plan_features", "d04_run_summary", "d05_measurements", "d07_slow_statements", "d11_rank_candidates", "d20_dashboard_stats",
    "d24_run_result_summary", "d37_corpus_bleu", "m11_auc", "m13_top_correlations", "m18_box_summary", "v02_best_match", "t03_top_of_poll",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    warm = int(os.environ.get("BENCH_WARM", "2"))
    only = os.environ.get("BENCH_ONLY")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    times, cold = {}, {}
    for name in only.split(",") if only else HEADLINES:
        runs = []
        for _ in range(1 + warm):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        cold[name] = round(runs[0], 3)
        times[name] = round(statistics.median(runs[1:] or runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "cold": cold, "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
