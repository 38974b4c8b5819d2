"""Every template, filled, runs in Spark as written and gives the rows another engine gives."""

import math

import pytest
from checker import duck
from conftest import DATA
from pyspark.sql import functions as F

from slowtide.operators import templates
from slowtide.plans.stack import Stack, on_stack
from slowtide.sources.tables import Tables

FOLDER = f"{DATA}/sf0.001"
ANSWERED: set[str] = set()


@pytest.fixture(scope="module")
def filled(spark):
    stack = Stack(spark, FOLDER)
    stack.views("users", "posts", "votes")
    draws = spark.createDataFrame([(3,)], "draw int")
    rows = templates.expand(draws, "draw", templates.limits(stack.users, stack.posts, stack.votes)).orderBy("template").collect()
    return [r.query_text for r in rows]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def _same(v):
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.6f}"
    return repr(v)


@pytest.mark.parametrize("i", range(len(templates.TEMPLATES)))
def test_template(spark, filled, con, i):
    text = filled[i]
    assert "{" not in text
    got = sorted(tuple(map(_same, r)) for r in spark.sql(text).collect())
    want = sorted(tuple(map(_same, r)) for r in con.execute(on_stack(text)).fetchall())
    assert len(got) == len(want)
    assert got == want
    if got:
        ANSWERED.add(templates.TEMPLATES[i][0])


def test_every_family_has_answers():
    """Runs after the statements above."""
    assert {f for f, _ in templates.TEMPLATES} == ANSWERED


def test_draws_repeat_and_differ(spark):
    draws = spark.range(20).withColumnRenamed("id", "draw")
    stack = Stack(spark, FOLDER)
    bounds = templates.limits(stack.users, stack.posts, stack.votes)
    one = {(r.draw, r.template): r.query_text for r in templates.expand(draws, "draw", bounds).collect()}
    two = {(r.draw, r.template): r.query_text for r in templates.expand(draws.repartition(4), "draw", bounds).collect()}
    assert one == two
    varied = next(i for i, (_, text) in enumerate(templates.TEMPLATES) if "{user}" in text)
    assert len({one[(d, varied)] for d in range(20)}) > 5


def test_views_of_stored_tables(spark, tmp_path):
    """A folder with the three tables themselves is enough to run statements as they were written."""
    for name in ("users", "posts"):
        getattr(Stack(spark, FOLDER), name).write.parquet(f"{tmp_path}/{name}.parquet")
    Tables(spark, str(tmp_path)).views("users", "posts")
    got = spark.sql(
        """SELECT u.id, (SELECT COUNT(*) FROM posts p WHERE p.owner_user_id = u.id) AS n
           FROM users u WHERE u.id IN (SELECT owner_user_id FROM posts WHERE EXTRACT(YEAR FROM creation_date) >= 1995)"""
    )
    want = Stack(spark, FOLDER).posts.groupBy("owner_user_id").agg(F.count("*").alias("n"), F.max(F.year("creation_date")).alias("y"))
    assert sorted(map(tuple, got.collect())) == sorted((r.owner_user_id, r.n) for r in want.filter("y >= 1995").collect())
    with pytest.raises(Exception, match="no_such_table"):
        Tables(spark, str(tmp_path)).views("no_such_table")
