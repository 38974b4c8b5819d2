"""The analytic workload over users, posts and votes, each query beside its check SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from slowtide.operators import aggregates as A
from slowtide.operators import joins as J
from slowtide.operators import ordered, windows
from slowtide.plans.stack import Stack, on_stack

QUERIES: dict = {}
CHECKS: dict = {}

c = F.col
AUTHORS = "FROM users u JOIN posts p ON p.owner_user_id = u.id"
CHAIN = AUTHORS + " JOIN votes v ON v.post_id = p.id"


def _add(name, build, sql):
    QUERIES[name] = lambda spark, folder: build(Stack(spark, folder))
    CHECKS[name] = on_stack(sql)


def day(text: str):
    return F.lit(dt.datetime.fromisoformat(text)).cast("timestamp_ntz")


def within(column: str, start: str, end: str):
    """start <= column < end: a range that reaches the Parquet statistics, unlike year(column)."""
    return (c(column) >= day(start)) & (c(column) < day(end))


def r4(column, name):
    return F.round(column, 4).alias(name)


def bigint(column, name):
    return column.cast("bigint").alias(name)


# ---- projection and filters

_add("p01_full_scan", lambda t: t.posts, "SELECT * FROM posts")
_add(
    "p02_projection",
    lambda t: t.posts.select("id", "title", "score", "view_count"),
    "SELECT id, title, score, view_count FROM posts",
)
_add(
    "p03_literal_tag",
    lambda t: t.posts.filter("score > 300").select("id", "title", "score", F.lit("high").alias("tier")),
    "SELECT id, title, score, 'high' AS tier FROM posts WHERE score > 300",
)
_add(
    "p04_comparisons",
    lambda t: t.posts.filter((c("post_type_id") == 1) & (c("score") >= 0) & (c("view_count") < 5000) & (c("answer_count") > 5)),
    "SELECT * FROM posts WHERE post_type_id = 1 AND score >= 0 AND view_count < 5000 AND answer_count > 5",
)
_add(
    "p05_between",
    lambda t: t.posts.filter(
        c("score").between(10, 100) & c("creation_date").between(day("1996-01-01"), day("1998-12-31"))
    ),
    "SELECT * FROM posts WHERE score BETWEEN 10 AND 100 AND creation_date BETWEEN '1996-01-01' AND '1998-12-31'",
)
_add(
    "p06_timestamp_literal",
    lambda t: t.votes.filter(c("creation_date") > day("1999-01-01")),
    "SELECT * FROM votes WHERE creation_date > '1999-01-01'",
)
_add(
    "p07_point_lookup",
    lambda t: t.posts.filter("id = 500").select("id", "title", "score"),
    "SELECT id, title, score FROM posts WHERE id = 500",
)
_add(
    "p08_in_list",
    lambda t: t.votes.filter(c("vote_type_id").isin(1, 2)).select("id", "post_id"),
    "SELECT id, post_id FROM votes WHERE vote_type_id IN (1, 2)",
)
_add(
    "p09_conjunction",
    lambda t: t.users.filter((c("reputation") > 500) & (c("reputation") < 1000)),
    "SELECT * FROM users WHERE reputation > 500 AND reputation < 1000",
)
_add(
    "p10_disjunction",
    lambda t: t.posts.filter((c("score") > 400) | (c("view_count") > 9000) | (c("answer_count") == 0)),
    "SELECT * FROM posts WHERE score > 400 OR view_count > 9000 OR answer_count = 0",
)
_add(
    "p11_substring",
    lambda t: t.users.filter(c("location").contains("EUROPE")),
    "SELECT * FROM users WHERE location LIKE '%EUROPE%'",
)
_add(
    "p12_substring_on_join",
    lambda t: J.with_author(t.posts, t.users.filter(c("location").contains("ASIA"))).select(
        "title", "score", c("u_display_name").alias("display_name")
    ),
    f"SELECT p.title, p.score, u.display_name {AUTHORS} WHERE u.location LIKE '%ASIA%'",
)
_add(
    "p13_case_folded",
    lambda t: t.users.filter((F.upper("display_name") == "HOUSEHOLD_010") | F.lower("location").contains("nation_1,")),
    "SELECT * FROM users WHERE upper(display_name) = 'HOUSEHOLD_010' OR lower(location) LIKE '%nation_1,%'",
)
_add(
    "p14_length",
    lambda t: t.users.filter(F.length("location") > 18),
    "SELECT * FROM users WHERE length(location) > 18",
)
_add(
    "p15_date_parts",
    lambda t: t.posts.filter(
        within("creation_date", "1997-01-01", "1998-01-01") & ((F.month("creation_date") == 6) | (F.dayofmonth("creation_date") == 1))
    ),
    """SELECT * FROM posts WHERE extract(year FROM creation_date) = 1997
       AND (extract(month FROM creation_date) = 6 OR extract(day FROM creation_date) = 1)""",
)
_add(
    "p16_not_null_not_empty",
    lambda t: t.users.filter(c("location").isNotNull() & (c("location") != "")).select("id", "location"),
    "SELECT id, location FROM users WHERE location IS NOT NULL AND location != ''",
)
_add(
    "p17_any_pattern",
    lambda t: t.posts.filter(c("title").contains("urgent") | c("title").contains("low") | c("title").contains("99")),
    "SELECT * FROM posts WHERE title LIKE '%urgent%' OR title LIKE '%low%' OR title LIKE '%99%'",
)

# ---- joins and subqueries

_add(
    "j01_inner_join",
    lambda t: J.with_author(t.posts, t.users).select("title", "score", c("u_display_name").alias("display_name"), c("u_reputation").alias("reputation")),
    f"SELECT p.title, p.score, u.display_name, u.reputation {AUTHORS}",
)
_add(
    "j02_three_tables",
    lambda t: J.with_votes(J.with_author(t.posts, t.users), t.votes).select(
        c("u_display_name").alias("display_name"), "title", "score", c("v_vote_type_id").alias("vote_type_id")
    ),
    f"SELECT u.display_name, p.title, p.score, v.vote_type_id {CHAIN}",
)
_add(
    "j03_left_join_counts",
    lambda t: J.post_totals(
        t.users,
        t.posts,
        {"good_posts": F.count_if(c("score") > 250), "bad_posts": F.count_if(c("score") <= 0), "total_posts": F.count("*")},
    ).select("id", "display_name", J.or_zero("good_posts"), J.or_zero("bad_posts"), J.or_zero("total_posts")),
    """SELECT u.id, u.display_name, COUNT(CASE WHEN p.score > 250 THEN 1 END) AS good_posts,
         COUNT(CASE WHEN p.score <= 0 THEN 1 END) AS bad_posts, COUNT(p.id) AS total_posts
       FROM users u LEFT JOIN posts p ON p.owner_user_id = u.id GROUP BY u.id, u.display_name""",
)
_add(
    "j04_inner_then_left",
    lambda t: J.with_vote_counts(t.posts.filter("score > 200"), t.votes, "left")
    .withColumn("fan", F.greatest("n_votes", F.lit(1)))
    .groupBy("owner_user_id")
    .agg(
        F.count("*").alias("posts"),
        F.sum("n_votes").alias("votes_received"),
        (F.sum(c("score") * c("fan")) / F.sum("fan")).alias("avg_score"),
    )
    .join(t.users.filter("reputation > 100"), c("owner_user_id") == c("id"))
    .select("id", "display_name", "location", "posts", "votes_received", r4(c("avg_score"), "avg_score")),
    f"""SELECT u.id, u.display_name, u.location, COUNT(DISTINCT p.id) AS posts, COUNT(DISTINCT v.id) AS votes_received,
         round(AVG(p.score), 4) AS avg_score
       {AUTHORS} LEFT JOIN votes v ON v.post_id = p.id
       WHERE u.reputation > 100 AND p.score > 200 GROUP BY u.id, u.display_name, u.location""",
)
_add(
    "j05_in_subquery",
    lambda t: J.having_match(t.votes, "post_id", t.posts.filter((c("post_type_id") == 1) & (c("score") > 300)), "id"),
    "SELECT * FROM votes WHERE post_id IN (SELECT id FROM posts WHERE post_type_id = 1 AND score > 300)",
)
_add(
    "j06_nested_in",
    lambda t: J.having_match(
        t.users, "id", J.having_match(t.posts, "id", t.votes.filter("vote_type_id = 2"), "post_id"), "owner_user_id"
    ),
    """SELECT * FROM users WHERE id IN (SELECT owner_user_id FROM posts
       WHERE id IN (SELECT post_id FROM votes WHERE vote_type_id = 2))""",
)
_add(
    "j07_exists",
    lambda t: J.having_match(t.users.filter("reputation > 5000"), "id", t.posts.filter("score > 400"), "owner_user_id").select(
        "display_name", "reputation"
    ),
    """SELECT u.display_name, u.reputation FROM users u WHERE u.reputation > 5000
       AND EXISTS (SELECT 1 FROM posts p WHERE p.owner_user_id = u.id AND p.score > 400)""",
)
_add(
    "j08_nested_exists",
    lambda t: J.having_match(
        t.users,
        "id",
        J.having_match(t.posts.filter("score > 350"), "id", t.votes.filter("vote_type_id = 7"), "post_id"),
        "owner_user_id",
    ).select("id", "display_name", "reputation"),
    """SELECT u.id, u.display_name, u.reputation FROM users u WHERE EXISTS (SELECT 1 FROM posts p
       WHERE p.owner_user_id = u.id AND p.score > 350
         AND EXISTS (SELECT 1 FROM votes v WHERE v.post_id = p.id AND v.vote_type_id = 7))""",
)
_add(
    "j09_not_exists",
    lambda t: J.lacking_match(t.posts.filter("score > 0"), "id", t.votes, "post_id").select("id", "title", "score"),
    """SELECT p.id, p.title, p.score FROM posts p
       WHERE NOT EXISTS (SELECT 1 FROM votes v WHERE v.post_id = p.id) AND p.score > 0""",
)
_add(
    "j10_self_join_posts",
    lambda t: J.first_pairs(
        t.posts,
        "owner_user_id",
        "id",
        c("score") > 50,
        {"left_id": "first.id", "right_id": "second.id", "left_score": "first.score", "right_score": "second.score"},
        100,
    ),
    # partners gathered per owner and unnested
    """WITH owned AS (SELECT owner_user_id, list({'id': id, 'score': score} ORDER BY id) AS own FROM posts WHERE owner_user_id IS NOT NULL GROUP BY owner_user_id),
       pair AS (SELECT a, b FROM owned, unnest(own) AS x(a), unnest(own) AS y(b) WHERE a.score > 50 AND b.id > a.id)
       SELECT a.id AS left_id, b.id AS right_id, a.score AS left_score, b.score AS right_score FROM pair ORDER BY left_id, right_id LIMIT 100""",
)
_add(
    "j10_self_join_locations",
    lambda t: J.first_pairs(
        t.users,
        "location",
        "id",
        c("reputation") > 2000,
        {"left_id": "first.id", "left_name": "first.display_name", "right_id": "second.id", "right_name": "second.display_name"},
        200,
    ),
    """WITH neighbours AS (SELECT location, list({'id': id, 'who': display_name, 'rep': reputation} ORDER BY id) AS own FROM users WHERE location IS NOT NULL GROUP BY location),
       pair AS (SELECT a, b FROM neighbours, unnest(own) AS x(a), unnest(own) AS y(b) WHERE a.rep > 2000 AND b.id > a.id)
       SELECT a.id AS left_id, a.who AS left_name, b.id AS right_id, b.who AS right_name FROM pair ORDER BY left_id, right_id LIMIT 200""",
)
_add(
    "j11_constant_join",
    lambda t: J.authors_and_voters(t.users, t.posts, t.votes, 440, 3, 500),
    """WITH wrote AS (SELECT DISTINCT posts.id, title, (SELECT any_value(display_name) FROM users WHERE users.id = owner_user_id) AS display_name
           FROM posts WHERE score > 440 AND owner_user_id IN (SELECT id FROM users)),
       judged AS (SELECT DISTINCT id, title FROM posts WHERE id IN (SELECT post_id FROM votes WHERE vote_type_id = 3)),
       everyone AS (SELECT display_name FROM users WHERE id IS NOT NULL GROUP BY display_name)
       SELECT *, 'author' AS role FROM wrote UNION ALL SELECT id, title, display_name, 'voter' FROM judged, everyone
       ORDER BY role, id, display_name NULLS LAST LIMIT 500""",
)
_add(
    "j12_join_aggregated_side",
    lambda t: J.post_totals(
        t.users,
        t.posts,
        {"written": F.count("*"), "mean_score": F.round(F.avg("score"), 4), "seen": F.sum("view_count")},
        "inner",
    ).select("display_name", "written", "mean_score", "seen"),
    # joined first, grouped afterwards
    f"""SELECT any_value(u.display_name) AS display_name, count(*) AS written, round(sum(p.score) / count(p.score), 4) AS mean_score,
         CAST(sum(p.view_count) AS BIGINT) AS seen {AUTHORS} GROUP BY u.id""",
)
_add(
    "j13_two_ctes_one_optional",
    lambda t: J.with_author(J.with_vote_counts(t.posts.filter("score > 300"), t.votes, "left"), t.users).select(
        "id", "title", "score", c("n_votes").alias("cast"), c("u_display_name").alias("writer")
    ),
    """SELECT id, title, score, (SELECT count(*) FROM votes WHERE post_id = posts.id) AS "cast",
         (SELECT any_value(display_name) FROM users WHERE users.id = posts.owner_user_id) AS writer
       FROM posts WHERE score > 300 AND owner_user_id IN (SELECT id FROM users)""",
)


def _location_totals(t):
    located = t.users.filter(c("location").isNotNull() & (c("location") != ""))
    owned = t.posts.groupBy("owner_user_id").agg(F.count("*").alias("n"))
    stats = located.groupBy("location").agg(F.count("*").alias("members"), F.avg("reputation").alias("standing"))
    posted = located.join(owned, c("id") == c("owner_user_id")).groupBy("location").agg(F.sum("n").alias("written"))
    return stats.join(posted, "location").select("location", "members", r4(c("standing"), "standing"), "written")


_add(
    "j14_rejoin_on_group_key",
    _location_totals,
    # one pass over the users with the number of posts of each
    """WITH owned AS (SELECT location, reputation, (SELECT count(*) FROM posts WHERE owner_user_id = users.id) AS n FROM users)
       SELECT location, count(*) AS members, round(avg(reputation), 4) AS standing, CAST(sum(n) AS BIGINT) AS written
       FROM owned WHERE length(location) > 0 GROUP BY location HAVING sum(n) > 0""",
)
_add(
    "j15_scalar_in_where",
    lambda t: t.posts.filter(
        (c("score") > t.posts.agg(F.avg("score")).scalar()) & (c("view_count") > t.posts.agg(F.avg("view_count")).scalar())
    ),
    """SELECT * FROM posts WHERE score > (SELECT AVG(score) FROM posts)
       AND view_count > (SELECT AVG(view_count) FROM posts)""",
)
_add(
    "j16_scalar_in_select",
    lambda t: t.posts.select(
        "id",
        "score",
        t.posts.agg(F.max("score")).scalar().alias("max_score"),
        t.posts.agg(F.round(F.avg("score"), 4)).scalar().alias("avg_score"),
        t.users.agg(F.count("*")).scalar().alias("n_users"),
    ),
    """SELECT id, score, (SELECT MAX(score) FROM posts) AS max_score, (SELECT round(AVG(score), 4) FROM posts) AS avg_score,
         (SELECT COUNT(*) FROM users) AS n_users FROM posts""",
)
_add(
    "j16_table_counts",
    lambda t: t.spark.range(1).select(
        t.users.agg(F.count("*")).scalar().alias("users"),
        t.posts.agg(F.count("*")).scalar().alias("posts"),
        t.votes.agg(F.count("*")).scalar().alias("votes"),
    ),
    "SELECT (SELECT COUNT(*) FROM users) AS users, (SELECT COUNT(*) FROM posts) AS posts, (SELECT COUNT(*) FROM votes) AS votes",
)
_add(
    "j17_correlated_scalar",
    lambda t: J.post_totals(
        t.users,
        t.posts.filter("score > 350"),
        {
            "post_count": F.count("*"),
            "avg_score": F.round(F.avg("score"), 4),
            "total_views": F.sum("view_count"),
            "max_score": F.max("score"),
            "min_score": F.min("score"),
        },
    ).select("id", "display_name", J.or_zero("post_count"), "avg_score", "total_views", "max_score", "min_score"),
    """SELECT u.id, u.display_name,
         (SELECT COUNT(*) FROM posts WHERE owner_user_id = u.id AND score > 350) AS post_count,
         (SELECT round(AVG(score), 4) FROM posts WHERE owner_user_id = u.id AND score > 350) AS avg_score,
         (SELECT CAST(SUM(view_count) AS BIGINT) FROM posts WHERE owner_user_id = u.id AND score > 350) AS total_views,
         (SELECT MAX(score) FROM posts WHERE owner_user_id = u.id AND score > 350) AS max_score,
         (SELECT MIN(score) FROM posts WHERE owner_user_id = u.id AND score > 350) AS min_score
       FROM users u""",
)
_add(
    "j18_two_correlated",
    lambda t: J.post_totals(
        t.users.filter("reputation > 100"), t.posts, {"best_score": F.max("score"), "total": F.count("*")}
    ).select("display_name", "best_score", J.or_zero("total")),
    """SELECT display_name, (SELECT MAX(score) FROM posts WHERE owner_user_id = users.id) AS best_score,
         (SELECT COUNT(*) FROM posts WHERE owner_user_id = users.id) AS total FROM users WHERE reputation > 100""",
)
_add(
    "j19_correlated_over_join",
    lambda t: J.post_totals(
        t.users, J.with_vote_counts(t.posts, t.votes.filter("vote_type_id = 2")), {"upvotes": F.sum("n_votes")}
    ).select("id", "display_name", J.or_zero("upvotes")),
    """SELECT id, display_name, (SELECT COUNT(*) FROM votes v JOIN posts p ON v.post_id = p.id
         WHERE p.owner_user_id = users.id AND v.vote_type_id = 2) AS upvotes FROM users""",
)
_add(
    "j20_correlated_with_semi_join",
    lambda t: J.post_totals(
        J.having_match(t.users, "id", t.posts.filter("view_count > 9800"), "owner_user_id"), t.posts, {"avg_score": F.avg("score")}
    ).select("display_name", r4(c("avg_score"), "avg_score")),
    """SELECT display_name, (SELECT round(AVG(score), 4) FROM posts WHERE owner_user_id = users.id) AS avg_score
       FROM users WHERE id IN (SELECT owner_user_id FROM posts WHERE view_count > 9800)""",
)
_add(
    "j23_filtered_cte",
    lambda t: J.post_totals(
        t.users.filter("reputation > 500"), t.posts.filter("score > 380"), {"posts": F.count("*"), "avg_score": F.avg("score")}
    ).select("id", "display_name", J.or_zero("posts"), r4(c("avg_score"), "avg_score")),
    """WITH active AS (SELECT id, display_name FROM users WHERE reputation > 500),
       scored AS (SELECT id, score, owner_user_id FROM posts WHERE score > 380)
       SELECT a.id, a.display_name, COUNT(s.id) AS posts, round(AVG(s.score), 4) AS avg_score
       FROM active a LEFT JOIN scored s ON s.owner_user_id = a.id GROUP BY a.id, a.display_name""",
)

# ---- aggregates

_add(
    "a01_global",
    lambda t: t.posts.agg(
        F.count("*").alias("n"), r4(F.avg("score"), "avg_score"), F.max("score").alias("max_score"),
        F.min("score").alias("min_score"), F.min("creation_date").alias("first_date"), F.max("creation_date").alias("last_date"),
    ),
    """SELECT COUNT(*) AS n, round(AVG(score), 4) AS avg_score, MAX(score) AS max_score, MIN(score) AS min_score,
         MIN(creation_date) AS first_date, MAX(creation_date) AS last_date FROM posts""",
)
_add(
    "a02_filtered_count",
    lambda t: t.votes.filter("vote_type_id = 2 AND post_id < 10000").agg(F.count("*").alias("n")),
    "SELECT COUNT(*) AS n FROM votes WHERE vote_type_id = 2 AND post_id < 10000",
)
_add(
    "a03_group_by_one",
    lambda t: t.posts.groupBy("post_type_id").agg(
        F.count("*").alias("n"), r4(F.avg("score"), "avg_score"), F.sum("view_count").alias("views"),
        F.max("score").alias("max_score"), F.min("score").alias("min_score"),
    ),
    """SELECT post_type_id, COUNT(*) AS n, round(AVG(score), 4) AS avg_score, CAST(SUM(view_count) AS BIGINT) AS views,
         MAX(score) AS max_score, MIN(score) AS min_score FROM posts GROUP BY post_type_id""",
)


def _by_type_and_place(t):
    owned = t.posts.groupBy("owner_user_id", "post_type_id").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    return (
        owned.join(t.users.filter("reputation > 100"), c("owner_user_id") == c("id"))
        .groupBy("location", "post_type_id")
        .agg(F.sum("n").alias("posts"), F.sum("s").alias("total_score"))
    )


_add(
    "a04_group_by_several",
    _by_type_and_place,
    f"""SELECT u.location, p.post_type_id, COUNT(p.id) AS posts, CAST(SUM(p.score) AS BIGINT) AS total_score
       {AUTHORS} WHERE u.reputation > 100 GROUP BY u.location, p.post_type_id""",
)
_add(
    "a05_group_by_expression",
    lambda t: t.posts.groupBy(bigint(F.month("creation_date"), "month")).agg(
        F.count("*").alias("n"), r4(F.avg("score"), "avg_score")
    ),
    """SELECT extract(month FROM creation_date) AS month, COUNT(*) AS n, round(AVG(score), 4) AS avg_score
       FROM posts GROUP BY extract(month FROM creation_date)""",
)
_add(
    "a06_group_by_alias",
    lambda t: t.posts.groupBy(bigint(F.year("creation_date"), "year"), bigint(F.month("creation_date"), "month")).agg(
        F.count("*").alias("posts"), r4(F.avg("score"), "avg_score")
    ),
    """SELECT extract(year FROM creation_date) AS year, extract(month FROM creation_date) AS month, COUNT(*) AS posts,
         round(AVG(score), 4) AS avg_score FROM posts GROUP BY year, month""",
)
_add(
    "a07_count_distinct",
    lambda t: t.users.join(
        J.with_vote_counts(t.posts, t.votes)
        .groupBy("owner_user_id")
        .agg(F.count("*").alias("n_posts"), F.sum("n_votes").alias("n_votes"), F.count_distinct("post_type_id").alias("n_types")),
        c("id") == c("owner_user_id"),
    ).select("id", "n_posts", "n_votes", "n_types"),
    f"""SELECT u.id, COUNT(DISTINCT p.id) AS n_posts, COUNT(DISTINCT v.id) AS n_votes,
         COUNT(DISTINCT p.post_type_id) AS n_types {CHAIN} GROUP BY u.id""",
)
_add(
    "a07_count_distinct_by_place",
    lambda t: J.with_author(t.posts, t.users).groupBy(c("u_location").alias("location")).agg(
        F.count_distinct("u_id").alias("users"), F.count_distinct("answer_count").alias("answer_counts"), F.count("*").alias("posts")
    ),
    f"""SELECT u.location, COUNT(DISTINCT u.id) AS users, COUNT(DISTINCT p.answer_count) AS answer_counts, COUNT(*) AS posts
       {AUTHORS} GROUP BY u.location""",
)
_add(
    "a08_having",
    lambda t: J.post_totals(t.users, t.posts, {"posts": F.count("*"), "avg_score": F.avg("score")}, "inner")
    .filter("posts > 8 AND avg_score > 200")
    .select("id", "display_name", "posts", r4(c("avg_score"), "avg_score")),
    f"""SELECT u.id, u.display_name, COUNT(p.id) AS posts, round(AVG(p.score), 4) AS avg_score {AUTHORS}
       GROUP BY u.id, u.display_name HAVING COUNT(p.id) > 8 AND AVG(p.score) > 200""",
)
_add(
    "a09_conditional_count",
    lambda t: A.vote_breakdown(
        t.users, t.posts, t.votes, {"first": c("vote_type_id") == 1, "second": c("vote_type_id") == 2, "third": c("vote_type_id") == 3}
    ),
    f"""SELECT u.id, u.display_name, count(*) FILTER (v.vote_type_id = 1) AS "first", count(*) FILTER (v.vote_type_id = 2) AS "second",
         count(*) FILTER (v.vote_type_id = 3) AS third {CHAIN} GROUP BY ALL""",
)
_add(
    "a10_conditional_sum",
    lambda t: J.post_totals(
        t.users,
        t.posts,
        {"gained": F.sum(F.greatest("score", F.lit(0))), "lost": F.sum(F.least("score", F.lit(0)))},
        "inner",
    ).select("id", "display_name", "gained", "lost"),
    f"""SELECT u.id, u.display_name, CAST(coalesce(sum(p.score) FILTER (p.score > 0), 0) AS BIGINT) AS gained,
         CAST(coalesce(sum(p.score) FILTER (p.score < 0), 0) AS BIGINT) AS lost {AUTHORS} GROUP BY ALL""",
)


def _avg_by_kind(t):
    owned = t.posts.groupBy("owner_user_id", "post_type_id").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    joined = owned.join(t.users, c("owner_user_id") == c("id")).groupBy("location")

    def avg_of(kind):
        inside = c("post_type_id") == kind
        return F.try_divide(F.sum(F.when(inside, c("s"))).cast("double"), F.sum(F.when(inside, c("n"))))

    return joined.agg(r4(avg_of(1), "asked_mean"), r4(avg_of(2), "answered_mean"))


_add(
    "a11_conditional_average",
    _avg_by_kind,
    f"""SELECT u.location, round(avg(p.score) FILTER (p.post_type_id = 1), 4) AS asked_mean, round(avg(p.score) FILTER (p.post_type_id = 2), 4) AS answered_mean
       {AUTHORS} GROUP BY ALL""",
)
_add(
    "a12_first_last_year",
    lambda t: J.post_totals(
        t.users, t.posts, {"began": F.min("creation_date"), "ended": F.max("creation_date"), "written": F.count("*")}, "inner"
    ).select("id", "display_name", bigint(F.year("began"), "began"), bigint(F.year("ended"), "ended"), "written"),
    f"""SELECT u.id, u.display_name, min(year(p.creation_date)) AS began, max(year(p.creation_date)) AS ended, count(*) AS written {AUTHORS} GROUP BY ALL""",
)
_add(
    "a13_distinct",
    lambda t: J.with_author(t.posts.select("owner_user_id", "post_type_id").distinct(), t.users)
    .select(c("u_location").alias("location"), "post_type_id")
    .distinct(),
    f"SELECT DISTINCT u.location, p.post_type_id {AUTHORS}",
)
_add(
    "a14_distinct_over_groups",
    # posts by owner and type first, so that the join meets groups; means are sums over counts
    lambda t: J.with_author(t.posts.groupBy("owner_user_id", "post_type_id").agg(F.sum("score").alias("s"), F.count("score").alias("n")), t.users)
    .groupBy(c("u_location").alias("location"), "post_type_id")
    .agg(r4(F.try_divide(F.sum("s").cast("double"), F.sum("n")), "avg_score"))
    .distinct(),
    f"SELECT DISTINCT u.location, p.post_type_id, round(AVG(p.score), 4) AS avg_score {AUTHORS} GROUP BY u.location, p.post_type_id",
)
_GRID = {
    "functions": ["COUNT", "SUM", "AVG", "MAX", "MIN"],
    "columns": ["score", "view_count", "answer_count"],
    "keys": ["u_location", "u_display_name", "post_type_id"],
}


def _grid_sql():
    parts = []
    for key, shown in (("u_location", "u.location"), ("u_display_name", "u.display_name"), ("post_type_id", "p.post_type_id")):
        for f in _GRID["functions"]:
            for col in _GRID["columns"]:
                parts.append(
                    f"""SELECT '{key}' AS key_name, CAST({shown} AS VARCHAR) AS key_value, '{f}' AS "function", '{col}' AS "column",
                        {"NULL" if f == "AVG" else f"CAST({f}(p.{col}) AS BIGINT)"} AS whole,
                        {f"round(AVG(p.{col}), 4)" if f == "AVG" else "CAST(NULL AS DOUBLE)"} AS mean {CHAIN} GROUP BY {shown}"""
                )
    return " UNION ALL ".join(parts)


_add(
    "a15_aggregate_grid",
    lambda t: A.aggregate_grid(t.users, t.posts, t.votes, **_GRID).withColumn("mean", F.round("mean", 4)),
    _grid_sql(),
)
_add(
    "a16_fan_out_totals",
    lambda t: A.posts_with_weights(t.users, t.posts, t.votes)
    .groupBy(c("u_display_name").alias("display_name"))
    .agg(
        A.weighted_sum("score").alias("total_score"),
        F.sum("n_votes").alias("n_votes"),
        r4(A.weighted_avg("score"), "avg_score"),
    ),
    f"""SELECT u.display_name, CAST(SUM(p.score) AS BIGINT) AS total_score, COUNT(v.id) AS n_votes,
         round(AVG(p.score), 4) AS avg_score {CHAIN} GROUP BY u.display_name""",
)


def _any_groups(t):
    groups = t.posts.join(J.vote_counts(t.votes), c("id") == c("post_id")).groupBy("title").agg(F.sum("n_votes").alias("n"))
    some = groups.limit(10)
    found = some.join(
        groups.select(c("title").alias("t2"), c("n").alias("n2")), c("title").eqNullSafe(c("t2")) & (c("n") == c("n2")), "left_semi"
    )
    return some.agg(F.count("*").alias("n_rows")).select("n_rows", found.agg(F.count("*")).scalar().alias("n_members"))


_add(
    "a17_group_then_any",
    _any_groups,
    """WITH groups AS (SELECT p.title, count(*) AS n FROM posts p JOIN votes v ON v.post_id = p.id GROUP BY p.title)
       SELECT least(10, count(*)) AS n_rows, least(10, count(*)) AS n_members FROM groups""",
)

# ---- windows

_add(
    "w01_running_total",
    lambda t: windows.running_total(t.posts, "owner_user_id", "creation_date", "score", "so_far").select("id", "owner_user_id", "score", "so_far"),
    # the sum over all posts of the owner up to that moment, without a window
    """WITH moments AS (SELECT owner_user_id AS who, creation_date AS moment, sum(score) AS s FROM posts GROUP BY ALL),
       added AS (SELECT a.who, a.moment, CAST(sum(b.s) AS BIGINT) AS so_far FROM moments a JOIN moments b ON a.who = b.who AND b.moment <= a.moment GROUP BY ALL)
       SELECT id, owner_user_id, score, so_far FROM posts JOIN added ON who = owner_user_id AND moment = creation_date""",
)
_add(
    "w01_running_total_few_keys",
    lambda t: windows.running_total(t.posts, "post_type_id", "creation_date", "score", "so_far").select("id", "post_type_id", "so_far"),
    """WITH moments AS (SELECT post_type_id AS kind, creation_date AS moment, sum(score) AS s FROM posts GROUP BY ALL),
       added AS (SELECT kind, moment, CAST(sum(s) OVER (PARTITION BY kind ORDER BY moment ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM moments)
       SELECT id, post_type_id, so_far FROM posts JOIN added ON kind = post_type_id AND moment = creation_date""",
)
_add(
    "w02_difference_from_group",
    lambda t: windows.group_average(t.posts, "post_type_id", "score", "mean", "above").select(
        "id", "score", "post_type_id", r4(c("mean"), "mean"), r4(c("above"), "above")
    ),
    """WITH means AS (SELECT post_type_id AS kind, avg(score) AS m FROM posts GROUP BY kind)
       SELECT id, score, post_type_id, round(m, 4) AS mean, round(score - m, 4) AS above FROM posts JOIN means ON kind IS NOT DISTINCT FROM post_type_id""",
)
_add(
    "w03_ntile",
    lambda t: ordered.ntile(t.users, [c("reputation").desc(), c("id").asc()], 4, "quartile").select("id", "reputation", "quartile"),
    "SELECT id, reputation, NTILE(4) OVER (ORDER BY reputation DESC, id) AS quartile FROM users",
)
_add(
    "w04_lag",
    lambda t: ordered.previous(
        t.posts.select("id", "post_type_id", "score", F.when(c("id") % 17 != 0, c("creation_date")).alias("at")), ["post_type_id"], ["at", "id"], "score", "before"
    ).select("id", "score", "before", (c("score") - c("before")).alias("change")),
    # unknown dates come last, as PostgreSQL orders them
    """WITH listed AS (SELECT list({'id': id, 'score': score} ORDER BY CASE WHEN id % 17 <> 0 THEN creation_date END NULLS LAST, id) AS l FROM posts GROUP BY post_type_id),
       placed AS (SELECT l, unnest(range(1, len(l) + 1)) AS k FROM listed)
       SELECT l[k].id AS id, l[k].score AS score, CASE WHEN k > 1 THEN l[k - 1].score END AS before, CASE WHEN k > 1 THEN l[k].score - l[k - 1].score END AS change FROM placed""",
)
_add(
    "w05_row_number",
    lambda t: ordered.positions(t.posts.select("id", "owner_user_id", "score"), ["owner_user_id"], [c("score").desc(), c("id").asc()], "place"),
    """WITH listed AS (SELECT owner_user_id, list({'id': id, 'score': score} ORDER BY score DESC, id) AS l FROM posts GROUP BY owner_user_id),
       placed AS (SELECT owner_user_id, l, unnest(range(1, len(l) + 1)) AS k FROM listed)
       SELECT l[k].id AS id, owner_user_id, l[k].score AS score, k AS place FROM placed""",
)
_add(
    "w06_first_value",
    lambda t: windows.leader(
        t.posts.select("id", "post_type_id", "title", F.when(c("id") % 19 != 0, c("score")).alias("score")), "post_type_id", "score", "id", "title", "best"
    ).select("id", "score", "best"),
    # an unknown score comes first in descending order
    """WITH rated AS (SELECT id, post_type_id AS kind, title, CASE WHEN id % 19 <> 0 THEN score END AS score FROM posts),
       best AS (SELECT kind, list(title ORDER BY score DESC NULLS FIRST, id)[1] AS best FROM rated GROUP BY kind)
       SELECT id, score, best FROM rated JOIN best USING (kind)""",
)
_add(
    "w07_rank_filtered",
    lambda t: J.post_totals(ordered.rank_at_most(t.users, "reputation", 1000, "place"), t.posts, {"written": F.count("*")}).select(
        "id", "display_name", "reputation", "place", J.or_zero("written")
    ),
    """WITH steps AS (SELECT reputation AS level, count(*) AS n FROM users GROUP BY level),
       above AS (SELECT level, 1 + coalesce(CAST(sum(n) OVER (ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS place FROM steps)
       SELECT id, display_name, reputation, place, (SELECT count(*) FROM posts WHERE owner_user_id = users.id) AS written
       FROM users JOIN above ON level = reputation WHERE place <= 1000""",
)

# ---- sort, limit, top-k

_add(
    "o01_full_sort",
    lambda t: t.posts.orderBy(c("score").desc_nulls_first(), "id"),
    "SELECT * FROM posts ORDER BY score DESC NULLS FIRST, id",
)
_add(
    "o02_top_n",
    lambda t: t.posts.orderBy(c("score").desc_nulls_first(), "id").limit(100).select("id", "title", "score"),
    "SELECT id, title, score FROM posts ORDER BY score DESC NULLS FIRST, id LIMIT 100",
)
_add(
    "o03_filtered_top_n_after_join",
    lambda t: J.with_author(t.posts.filter("score > 200"), t.users.filter("reputation > 1000"))
    .orderBy(c("score").desc_nulls_first(), "id")
    .limit(50)
    .select("id", "title", "score", c("u_display_name").alias("display_name"), c("u_reputation").alias("reputation")),
    f"""SELECT p.id, p.title, p.score, u.display_name, u.reputation {AUTHORS}
       WHERE p.score > 200 AND u.reputation > 1000 ORDER BY p.score DESC NULLS FIRST, p.id LIMIT 50""",
)


def _any_rows(t):
    matching = t.posts.filter("score > 100")
    some = matching.select("id", "title").limit(20)
    found = J.having_match(some, "id", matching, "id")
    return some.agg(F.count("*").alias("n_rows")).select("n_rows", found.agg(F.count("*")).scalar().alias("n_members"))


_add(
    "o04_any_n_rows",
    _any_rows,
    "SELECT LEAST(COUNT(*), 20) AS n_rows, LEAST(COUNT(*), 20) AS n_members FROM posts WHERE score > 100",
)
_add(
    "o05_order_by_aggregate",
    lambda t: ordered.positions(
        t.users.groupBy("location").agg(F.count("*").alias("members"), r4(F.avg("reputation"), "standing")), [], [c("members").desc(), c("location").asc_nulls_last()], "place"
    ),
    """SELECT *, row_number() OVER (ORDER BY members DESC, location NULLS LAST) AS place
       FROM (SELECT location, count(*) AS members, round(avg(reputation), 4) AS standing FROM users GROUP BY location)""",
)
_add(
    "o06_order_by_expression",
    lambda t: ordered.positions(t.users.select("id", "display_name"), [], [F.lower("display_name").asc_nulls_last(), c("id").asc()], "place"),
    "SELECT id, display_name, row_number() OVER (ORDER BY lower(display_name) NULLS LAST, id) AS place FROM users",
)

def _years_and_places(t):
    """Posts are grouped by owner and year before they meet their owners."""
    owned = t.posts.groupBy("owner_user_id", bigint(F.year("creation_date"), "year")).agg(F.count("*").alias("n"), F.sum("score").alias("s"), F.count("score").alias("k"))
    totals = owned.join(t.users.select("id", "location"), c("owner_user_id") == c("id")).groupBy("year", "location")
    grouped = totals.agg(F.sum("n").alias("written"), r4(F.try_divide(F.sum("s").cast("double"), F.sum("k")), "mean_score"))
    return ordered.positions(grouped, [], [c("year").desc(), c("written").asc(), c("location").asc_nulls_last()], "place")


_add(
    "o07_mixed_directions",
    _years_and_places,
    f"""SELECT *, row_number() OVER (ORDER BY year DESC, written, location NULLS LAST) AS place
       FROM (SELECT year(p.creation_date) AS year, u.location, count(*) AS written, round(avg(p.score), 4) AS mean_score {AUTHORS} GROUP BY ALL)""",
)
_add(
    "o08_order_by_hidden_column",
    lambda t: ordered.positions(
        J.with_author(t.posts, t.users).select("id", "title", "score", "u_reputation"), [], [c("u_reputation").desc_nulls_first(), c("id").asc()], "place"
    ).select("title", "score", "place"),
    f"SELECT p.title, p.score, row_number() OVER (ORDER BY u.reputation DESC NULLS FIRST, p.id) AS place {AUTHORS}",
)
_add(
    "o08_order_by_nullable",
    lambda t: ordered.positions(t.posts.select("id", "title"), [], [c("title").asc_nulls_last(), c("id").asc()], "place"),
    "SELECT id, title, row_number() OVER (ORDER BY title NULLS LAST, id) AS place FROM posts",
)

# ---- set operations


def _tag(df, name, value, *columns):
    return df.select(*columns, F.lit(value).alias(name))


_add(
    "u01_disjoint_tiers",
    lambda t: t.posts.filter("score >= 120").select("id", "title", "score", F.when(c("score") > 280, "upper").otherwise("lower").alias("band")),
    """SELECT id, title, score, CASE WHEN score > 280 THEN 'upper' ELSE 'lower' END AS band FROM posts WHERE score >= 120""",
)
_add(
    "u02_overlapping_branches",
    lambda t: _tag(t.posts.filter("score > 400"), "because", "rated", "id", "title", "score").unionByName(
        _tag(t.posts.filter("view_count > 9500"), "because", "seen", "id", "title", "score")
    ),
    """SELECT id, title, score, unnest(list_filter(['rated', 'seen'], lambda x: CASE x WHEN 'rated' THEN score > 400 ELSE view_count > 9500 END)) AS because FROM posts""",
)


def _involvement(t):
    posts = t.posts.filter(c("post_type_id").isin(1, 2)).select("owner_user_id", "title", "score", "post_type_id").distinct()
    return (
        J.with_author(posts, t.users)
        .select(
            c("u_display_name").alias("who"),
            "title",
            "score",
            F.when(c("post_type_id") == 1, "question").otherwise("answer").alias("part"),
        )
        .distinct()
    )


_add(
    "u03_distinct_union",
    _involvement,
    f"""SELECT DISTINCT u.display_name AS who, p.title, p.score, ['question', 'answer'][p.post_type_id] AS part {AUTHORS} WHERE p.post_type_id IN (1, 2)""",
)


def _stacked_totals(t):
    kinds = {"any": F.lit(True), "question": c("post_type_id") == 1, "answer": c("post_type_id") == 2}
    one = t.posts.agg(
        *[F.count_if(w).alias(f"n_{k}") for k, w in kinds.items()],
        *[F.avg(F.when(w, c("score"))).alias(f"a_{k}") for k, w in kinds.items()],
    )
    rows = F.array(*[F.struct(F.lit(k).alias("part"), c(f"n_{k}").alias("written"), c(f"a_{k}").alias("mean_score")) for k in kinds])
    return one.select(F.inline(rows)).withColumn("mean_score", F.round("mean_score", 4))


_add(
    "u04_stacked_totals",
    _stacked_totals,
    """SELECT part, count(*) AS written, round(avg(score), 4) AS mean_score
       FROM (SELECT score, unnest(CASE post_type_id WHEN 1 THEN ['any', 'question'] WHEN 2 THEN ['any', 'answer'] ELSE ['any'] END) AS part FROM posts) GROUP BY part""",
)


def _place_counts(t):
    located = t.users.filter(c("location").isNotNull())
    owned = t.posts.groupBy("owner_user_id").agg(F.count("*").alias("n"))
    users = located.groupBy("location").agg(F.count("*").alias("total"))
    posts = located.join(owned, c("id") == c("owner_user_id")).groupBy("location").agg(F.sum("n").alias("total"))
    return _tag(users, "what", "members", "location", "total").unionByName(_tag(posts, "what", "written", "location", "total"))


_add(
    "u05_union_of_groups",
    _place_counts,
    """WITH owned AS (SELECT location, (SELECT count(*) FROM posts WHERE owner_user_id = users.id) AS n FROM users WHERE location IS NOT NULL)
       SELECT location, count(*) AS total, 'members' AS what FROM owned GROUP BY location
       UNION ALL SELECT location, CAST(sum(n) AS BIGINT), 'written' FROM owned GROUP BY location HAVING sum(n) > 0""",
)

# ---- scalar functions

_add(
    "f01_case_and_length",
    lambda t: t.users.select(
        "id", F.lower("location").alias("low"), F.upper("display_name").alias("up"), bigint(F.length("location"), "len")
    ),
    "SELECT id, lower(location) AS low, upper(display_name) AS up, length(location) AS len FROM users",
)
_add(
    "f02_extract",
    lambda t: t.votes.select(
        "id", bigint(F.year("creation_date"), "y"), bigint(F.month("creation_date"), "m"), bigint(F.dayofmonth("creation_date"), "d")
    ),
    """SELECT id, extract(year FROM creation_date) AS y, extract(month FROM creation_date) AS m,
         extract(day FROM creation_date) AS d FROM votes""",
)
_add(
    "f03_case_tiers",
    lambda t: t.posts.select("id", F.when(c("score") >= 350, "top").when(c("score") >= 120, "good").when(c("score") > 0, "fair").otherwise("low").alias("band")),
    "SELECT id, coalesce(['low', 'fair', 'good', 'top'][1 + (score > 0)::INT + (score >= 120)::INT + (score >= 350)::INT], 'low') AS band FROM posts",
)
_add(
    "f04_coalesce",
    lambda t: t.posts.select("id", F.coalesce("title", F.lit("(none)")).alias("title")),
    "SELECT id, COALESCE(title, '(none)') AS title FROM posts",
)
_add(
    "f08_truncate_trim_prefix",
    lambda t: t.benchmark.select(
        "item_id",
        F.substring("text", 1, 100).alias("head"),
        F.trim(F.substring("text", 1, 6)).alias("trimmed"),
        F.upper("text").startswith("TH").alias("starts"),
    ),
    """SELECT item_id, substr(text, 1, 100) AS head, trim(substr(text, 1, 6)) AS trimmed,
         upper(text) LIKE 'TH%' AS starts FROM benchmark""",
)
