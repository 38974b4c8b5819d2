"""Query tables composed from pieces: sources, conditions, groupings and folds, filled with values of the tables.

Every family of statements combines pieces that share a table alias. A draw fills all of them; each value lies
between the smallest and the largest one that the tables hold, picked by a seeded hash of the draw.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCES = {
    "u": "users u",
    "p": "posts p",
    "up": "users u JOIN posts p ON p.owner_user_id = u.id",
    "pv": "posts p JOIN votes v ON v.post_id = p.id",
    "upv": "users u JOIN posts p ON p.owner_user_id = u.id JOIN votes v ON v.post_id = p.id",
}
CONDITIONS = [
    ("u", "u.reputation >= {reputation}"),
    ("u", "u.location = (SELECT location FROM users WHERE id = {user})"),
    ("p", "p.score BETWEEN {score} AND {score} + 60"),
    ("p", "EXTRACT(YEAR FROM p.creation_date) = {year}"),
    ("v", "v.vote_type_id <= {vote}"),
]
GROUPS = [("u", "u.location"), ("p", "p.post_type_id"), ("p", "EXTRACT(MONTH FROM p.creation_date)")]
FOLDS = ["COUNT(*)", "AVG(p.score)", "MAX(p.view_count)"]
#: Bounds that do not come from a table.
FREE = {"few": (2, 6), "n": (5, 60)}


def _compose() -> list[tuple[str, str]]:
    out = []
    for (tables, source), (needs, condition) in product(SOURCES.items(), CONDITIONS):
        if needs in tables:
            out.append(("rows", f"SELECT {tables[0]}.id FROM {source} WHERE {condition} ORDER BY 1 LIMIT {{n}}"))
    for (tables, source), (needs, group), fold in product(SOURCES.items(), GROUPS, FOLDS):
        if needs in tables and "p" in tables and len(tables) > 1:
            out.append(("grouped", f"SELECT {group} AS part, {fold} AS result FROM {source} GROUP BY {group}"))
    for needs, group in GROUPS:
        grouped = f"SELECT {group} AS part, COUNT(*) AS total FROM {SOURCES['up']} GROUP BY {group}"
        out.append(("having", f"{grouped} HAVING COUNT(*) >= {{few}} AND MAX(p.score) >= {{score}}"))
        out.append(("with", f"WITH totals AS ({grouped}) SELECT part FROM totals WHERE total > {{few}} ORDER BY total DESC, part LIMIT {{n}}"))
        out.append(("case", f"SELECT {group} AS part, SUM(CASE WHEN v.vote_type_id <= {{vote}} THEN 1 ELSE 0 END) AS hits FROM {SOURCES['upv']} GROUP BY {group}"))
    for word in ("", "NOT "):
        for table, link in (("users t", "posts p WHERE p.owner_user_id = t.id AND p.score >= {score}"), ("posts t", "votes v WHERE v.post_id = t.id AND v.vote_type_id <= {vote}")):
            out.append(("exists", f"SELECT t.id FROM {table} WHERE {word}EXISTS (SELECT 1 FROM {link})"))
    for joiner in ("UNION", "UNION ALL", "EXCEPT"):
        out.append(("sets", f"SELECT p.post_type_id, p.score FROM posts p WHERE p.score >= {{score}} {joiner} SELECT p.post_type_id, p.score FROM posts p WHERE p.post_type_id = {{kind}}"))
    for rank in ("RANK()", "ROW_NUMBER()", "SUM(p.score)", "LAG(p.id)"):
        out.append(("window", f"SELECT p.id, {rank} OVER (PARTITION BY p.post_type_id ORDER BY p.score DESC, p.id) AS place FROM posts p"))
    out += [
        ("lookup", "SELECT * FROM users WHERE id = {user}"),
        ("lookup", "SELECT score, view_count FROM posts WHERE id >= {post} ORDER BY id LIMIT 1"),
        ("dates", "SELECT EXTRACT(YEAR FROM creation_date) AS y, COUNT(*) AS total FROM votes WHERE EXTRACT(MONTH FROM creation_date) = {month} GROUP BY 1"),
        ("pairs", "SELECT l.id AS one, r.id AS other FROM posts l JOIN posts r ON r.owner_user_id = l.owner_user_id AND r.id > l.id ORDER BY 1, 2 LIMIT {n}"),
        ("scalar", "SELECT u.id, (SELECT COUNT(*) FROM posts p WHERE p.owner_user_id = u.id AND p.score >= {score}) AS total FROM users u WHERE u.reputation >= {reputation}"),
    ]
    return sorted(out, key=lambda x: x[1])


TEMPLATES = _compose()


def limits(users: DataFrame, posts: DataFrame, votes: DataFrame) -> dict[str, tuple[Column, Column]]:
    """The smallest and largest value of every placeholder, from the tables."""

    def both(df: DataFrame, value: Column) -> tuple[Column, Column]:
        return tuple(df.agg(fold(value).cast("bigint")).scalar() for fold in (F.min, F.max))

    of = {
        "reputation": (users, F.col("reputation")), "user": (users, F.col("id")), "score": (posts, F.col("score")),
        "year": (posts, F.year("creation_date")), "post": (posts, F.col("id")), "kind": (posts, F.col("post_type_id")),
        "month": (votes, F.month("creation_date")), "vote": (votes, F.col("vote_type_id")),
    }
    return {name: both(*x) for name, x in of.items()} | {n: (F.lit(a), F.lit(b)) for n, (a, b) in FREE.items()}


def _hash(draw: Column, name: str, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:{name}:"), draw.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def expand(draws: DataFrame, draw: str, bounds: dict[str, tuple[Column, Column]], seed: int = 7) -> DataFrame:
    """`family`, `position` and `query_text` for every draw and template."""
    values = [(low + _hash(F.col(draw), n, seed) % (high - low + 1)).cast("string").alias(n) for n, (low, high) in bounds.items()]
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(f).alias("family"), F.lit(t).alias("text")) for i, (f, t) in enumerate(TEMPLATES)])
    each = draws.select(draw, F.struct(*values).alias("v")).select(draw, "v", F.inline(rows))
    text = F.col("text")
    for name in bounds:
        text = F.replace(text, F.lit("{" + name + "}"), F.col(f"v.{name}"))
    position = F.col(draw) * len(TEMPLATES) + F.col("template")
    return each.select(F.col(draw), "template", "family", position.alias("position"), text.alias("query_text"))
