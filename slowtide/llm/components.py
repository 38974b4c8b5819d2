"""Connected components of a graph given as a table of links.

Large-star and small-star steps (Kiveris et al., 2014) alternate until the links no longer change: every
node then points at the smallest node of its component. Each step groups and joins on a node and cuts its
lineage with a written table; a step's minima are written before the join, so that a hub's links, on either
side, are an ordinary shuffle that adaptive execution may split. Nothing but a row of counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.session import materialize

ROUNDS = 60


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least(links: DataFrame) -> DataFrame:
    """The smallest of a node's neighbours and itself."""
    least = links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    return materialize(least, "least")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _least(both)
    return both.join(low, both.a == low.node).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    low = _least(down)
    joined = down.join(low, down.a == low.node)
    return joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select(F.col("node").alias("a"), F.col("low").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; `links` has bigint columns a and b, in any order.

    The root is the smallest node of the component. Loops and repeated links are allowed; an empty table
    gives an empty one.
    """
    now = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = _state(now)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        large = materialize(_large_star(now).distinct(), "links")
        now = materialize(_small_star(large).distinct(), "links")
        after = _state(now)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
