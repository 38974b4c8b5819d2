"""Joins and subqueries over users, posts and votes.

Sides that are only counted are grouped by the join key before the join, so a post or user with
most of the rows reaches the join as one row. Sides that are only tested for existence are
reduced to their distinct keys first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.session import materialize


def having_match(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of `left` whose key occurs in `right` (IN, EXISTS)."""
    keys = right.select(F.col(right_key).alias("match__")).distinct()
    return left.join(keys, F.col(left_key) == F.col("match__"), "left_semi")


def lacking_match(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of `left` whose key does not occur in `right` (NOT EXISTS)."""
    keys = right.select(F.col(right_key).alias("match__")).distinct()
    return left.join(keys, F.col(left_key) == F.col("match__"), "left_anti")


def with_author(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts joined to their authors; user columns get the prefix `u_`."""
    authors = users.select([F.col(c).alias(f"u_{c}") for c in users.columns])
    return posts.join(authors, F.col("owner_user_id") == F.col("u_id"))


def with_votes(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """Posts joined to each of their votes; vote columns get the prefix `v_`."""
    cast = votes.select([F.col(c).alias(f"v_{c}") for c in votes.columns])
    return posts.join(cast, F.col("id") == F.col("v_post_id"))


def vote_counts(votes: DataFrame) -> DataFrame:
    return votes.groupBy("post_id").agg(F.count("*").alias("n_votes"))


def with_vote_counts(posts: DataFrame, votes: DataFrame, how: str = "inner") -> DataFrame:
    """Posts with `n_votes`; `how="left"` keeps posts without votes, counted as 0."""
    counted = posts.join(vote_counts(votes), F.col("id") == F.col("post_id"), how).drop("post_id")
    return counted.withColumn("n_votes", F.coalesce("n_votes", F.lit(0)))


def post_totals(users: DataFrame, posts: DataFrame, totals: dict[str, Column], how: str = "left") -> DataFrame:
    """Users with aggregates over their posts: the correlated scalar subquery in SELECT.

    A user without posts gets NULL; wrap counts with `or_zero`.
    """
    per_owner = posts.groupBy("owner_user_id").agg(*[c.alias(n) for n, c in totals.items()])
    return users.join(per_owner, F.col("id") == F.col("owner_user_id"), how).drop("owner_user_id")


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)


def first_pairs(
    df: DataFrame, key: str, ident: str, head: Column, columns: dict[str, str], limit: int
) -> DataFrame:
    """First `limit` pairs (a, b) with a.key = b.key, a.ident < b.ident and `head` true of a,
    in order of (a.ident, b.ident). `columns` maps an output name to `first.col` or `second.col`.

    A key may hold most rows, so its pairs are never built. Only `limit` rows can open the first
    pairs. One pass counts how many partners each of them has; those after the point where the
    limit is reached are dropped, and only then are partners joined: at most `limit` pairs plus
    one row's partners.
    """
    last = df.groupBy(F.col(key).alias("key__")).agg(F.max(ident).alias("last__"))
    found = (
        df.filter(head)
        .join(last, F.col(key) == F.col("key__"))
        .filter(F.col(ident) < F.col("last__"))
        .drop("key__", "last__")
        .orderBy(ident)
        .limit(limit)
    )
    # at most `limit` rows, read by the counts and by the pairs
    heads = materialize(found, "heads")
    marks = heads.groupBy(F.col(key).alias("key__")).agg(F.sort_array(F.collect_list(ident)).alias("marks__"))
    passed = F.size(F.filter("marks__", lambda m: m < F.col(ident)))
    later = (
        df.join(F.broadcast(marks), F.col(key) == F.col("key__"))
        .groupBy("key__", passed.alias("passed__"))
        .agg(F.count("*").alias("n__"))
    )
    opened = marks.select(F.col("key__").alias("open_key__"), F.posexplode("marks__").alias("nth__", "mark__"))
    partners = (
        opened.join(later, (F.col("open_key__") == F.col("key__")) & (F.col("passed__") > F.col("nth__")))
        .groupBy("mark__")
        .agg(F.sum("n__").alias("n__"))
    )
    before = Window.orderBy("mark__").rowsBetween(Window.unboundedPreceding, -1)
    needed = partners.withColumn("before__", F.coalesce(F.sum("n__").over(before), F.lit(0))).filter(
        F.col("before__") < limit
    )
    first = heads.join(F.broadcast(needed), F.col(ident) == F.col("mark__")).select(
        F.struct(*[F.col(c) for c in df.columns]).alias("first")
    )
    second = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("second"))
    return (
        second.join(
            F.broadcast(first),
            (F.col(f"first.{key}") == F.col(f"second.{key}")) & (F.col(f"first.{ident}") < F.col(f"second.{ident}")),
        )
        .orderBy(f"first.{ident}", f"second.{ident}")
        .limit(limit)
        .select(*[F.col(c).alias(n) for n, c in columns.items()])
    )


def authors_and_voters(
    users: DataFrame, posts: DataFrame, votes: DataFrame, min_score: int, vote_type: int, limit: int
) -> DataFrame:
    """Distinct (post, title, name, role) rows: authors of posts above a score, and every user as
    possible voter on every post with such a vote; the first `limit` by role, post and name.

    The voter part is a product of posts and users. Its first rows need only the first `limit`
    posts and the first `limit` names, so those are cut before they meet.
    """
    authors = with_author(posts.filter(F.col("score") > min_score), users).select(
        "id", "title", F.col("u_display_name").alias("display_name"), F.lit("author").alias("role")
    )
    voted = (
        having_match(posts, "id", votes.filter(F.col("vote_type_id") == vote_type), "post_id")
        .select("id", "title")
        .orderBy("id")
        .limit(limit)
    )
    names = (
        users.select("display_name")
        .distinct()
        .orderBy(F.col("display_name").asc_nulls_last())
        .limit(limit)
        .agg(F.collect_list(F.struct("display_name")))
        .scalar()
    )
    voters = voted.select("id", "title", F.inline(names), F.lit("voter").alias("role"))
    return (
        authors.union(voters)
        .distinct()
        .orderBy("role", "id", F.col("display_name").asc_nulls_last())
        .limit(limit)
    )
