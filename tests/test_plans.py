"""Physical plans: what must and must not appear in them."""

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from slowtide.operators import pairs
from slowtide.plans import all_queries
from slowtide.plans.fixtures import Log

FOLDER = f"{DATA}/sf0.001"
QUERIES = all_queries()
RELATIONAL = [n for n in QUERIES if re.match(r"[pjawou]\d\d_", n) and n not in ("j21_resume_anti_join", "j22_label_lookup")]


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


# one row per slice, per kept rank, or per opened pair: bounded by a parameter
BOUNDED_WINDOW = {
    "j10_self_join_posts", "j10_self_join_locations", "w03_ntile", "w07_rank_filtered",
    "o05_order_by_aggregate", "o06_order_by_expression", "o07_mixed_directions", "o08_order_by_hidden_column", "o08_order_by_nullable",
}


@pytest.mark.parametrize("name", [n for n in RELATIONAL if n not in BOUNDED_WINDOW])
def test_no_window_over_everything(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for window in re.findall(r"\(\d+\) Window\n(?:.*\n)*?\n", text):
        partition = re.search(r"Arguments: \[.*?\], \[(.*?)\]", window)
        assert partition and partition.group(1), window


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["p07_point_lookup"](spark, FOLDER))
    assert "EqualTo(o_orderkey,500)" in text
    text = plan(QUERIES["p15_date_parts"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    text = plan(QUERIES["a03_group_by_one"](spark, FOLDER))
    assert re.search(r"ReadSchema: struct<o_orderstatus:string,o_totalprice:double>", text)
    text = plan(QUERIES["a02_filtered_count"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["o02_top_n"](spark, FOLDER))


def test_first_rows_are_limited_before_the_shuffle(spark):
    for name in ("d08_first_seen", "d05_measurements", "d33_sample_by_severity", "m19_worst_errors"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert re.search(r"WindowGroupLimit\n(?:.*\n)*?.*Partial", text), name


def test_grams_are_counted_where_their_text_is(spark):
    rows = Log(spark, FOLDER).pairs.withColumn("split", F.lit("x"))
    text = plan(pairs.corpus_bleu(rows, "pair_id", "optimized", "slow", "split"))
    assert not re.search(r"hashpartitioning\([^)]*gram", text)
    assert text.count("REPARTITION_BY_COL") >= 1


# exchanges without broadcasts, as between tables too large for them; what `materialize` wrote before is not in the plan
@pytest.mark.parametrize("name, most", [("d04_run_summary", 12), ("d24_run_result_summary", 6), ("m18_box_summary", 5), ("j10_self_join_posts", 9)])
def test_exchanges_without_broadcasts(spark, name, most):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange (") <= most, tree
