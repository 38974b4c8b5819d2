"""Aggregates over the joined tables, computed on rows that were grouped before the join.

After joining votes, a post counts once per vote. That fan-out is part of the result, so sums
weigh each post by its number of votes instead of repeating the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.operators.joins import with_author, with_vote_counts


def weighted_sum(column: str) -> Column:
    return F.sum(F.col(column) * F.col("n_votes"))


def weighted_count(column: str) -> Column:
    return F.sum(F.when(F.col(column).isNotNull(), F.col("n_votes")).otherwise(F.lit(0)))


def weighted_avg(column: str) -> Column:
    """NULL for a group without any value."""
    return F.try_divide(weighted_sum(column).cast("double"), weighted_count(column))


def posts_with_weights(users: DataFrame, posts: DataFrame, votes: DataFrame, how: str = "inner") -> DataFrame:
    """Posts with author columns and `n_votes` instead of one row per vote."""
    return with_author(with_vote_counts(posts, votes, how), users)


def vote_breakdown(users: DataFrame, posts: DataFrame, votes: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """Votes received per user, one conditional count per kind."""
    per_post = votes.groupBy("post_id").agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])
    per_owner = (
        posts.select("id", "owner_user_id")
        .join(per_post, F.col("id") == F.col("post_id"))
        .groupBy("owner_user_id")
        .agg(*[F.sum(n).alias(n) for n in kinds])
    )
    return users.join(per_owner, F.col("id") == F.col("owner_user_id")).select("id", "display_name", *kinds)


def aggregate_grid(
    users: DataFrame,
    posts: DataFrame,
    votes: DataFrame,
    functions: Sequence[str],
    columns: Sequence[str],
    keys: Sequence[str],
) -> DataFrame:
    """Every function of every column by every key over users-posts-votes, in long form.

    Counts, sums and extremes are in `whole` (bigint), means in `mean`. The joined rows are grouped once
    by all keys; since every fold can be folded again, grouping sets then give each key's totals.
    """
    base = posts_with_weights(users, posts, votes)
    parts = {c: {"n": F.sum, "s": F.sum, "low": F.min, "high": F.max} for c in columns}
    once = base.groupBy(*keys).agg(
        *[x.alias(f"{p}_{c}") for c in columns for p, x in (("n", weighted_count(c)), ("s", weighted_sum(c)), ("low", F.min(c)), ("high", F.max(c)))]
    )
    active = {k: F.grouping(k) == 0 for k in keys}
    totals = once.groupingSets([[k] for k in keys], *keys).agg(
        F.coalesce(*[F.when(on, F.lit(k)) for k, on in active.items()]).alias("key_name"),
        F.coalesce(*[F.when(on, F.col(k).cast("string")) for k, on in active.items()]).alias("key_value"),
        *[fold(f"{p}_{c}").cast("bigint").alias(f"total_{p}_{c}") for c, folds in parts.items() for p, fold in folds.items()],
    )
    nothing = F.lit(None)

    def cell(function: str, column: str) -> Column:
        n, s, low, high = (F.col(f"total_{p}_{column}") for p in ("n", "s", "low", "high"))
        whole = {"COUNT": n, "SUM": s, "MAX": high, "MIN": low}.get(function, nothing)
        mean = F.try_divide(s.cast("double"), n) if function == "AVG" else nothing
        return F.struct(F.lit(function).alias("function"), F.lit(column).alias("column"), whole.cast("bigint").alias("whole"), mean.cast("double").alias("mean"))

    cells = F.array(*[cell(f, c) for f in functions for c in columns])
    return totals.select("key_name", "key_value", F.inline(cells))
