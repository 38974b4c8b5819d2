"""Columns over statement text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text features, in the order the models expect them.
TEXT_FEATURES = [
    "has_select_star", "has_like_wildcard", "join_count", "has_subquery",
    "has_group_by", "has_order_by_no_limit", "has_or", "has_function_in_where",
]
# Function calls that count as "function in WHERE" wherever they stand.
FUNCTION_CALLS = ["LOWER(", "UPPER(", "EXTRACT(", "LENGTH("]
# Strategy labels.
DROP_STAR, TO_JOIN, FEWER_JOINS = "remove SELECT *", "rewrite subquery as JOIN", "reduce JOINs"
ADD_WHERE, ADD_LIMIT, OTHER = "add WHERE filter", "add LIMIT", "rewrite query"
# Fixed value: what precedes the answer in a generated text.
ANSWER_MARK = "### Optimized Query"


def occurrences(text: Column, piece: str) -> Column:
    """How often `piece` occurs, without overlaps."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(piece)))
    return (removed / len(piece)).cast("int")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def text_features(query: Column) -> dict[str, Column]:
    """The eight text features as ints, by substring rules on the upper-cased text."""
    up = F.upper(query)
    called = up.contains(FUNCTION_CALLS[0])
    for name in FUNCTION_CALLS[1:]:
        called = called | up.contains(name)
    return {
        "has_select_star": up.contains("SELECT *").cast("int"),
        "has_like_wildcard": up.contains("LIKE '%").cast("int"),
        "join_count": occurrences(up, "JOIN"),
        "has_subquery": (occurrences(up, "SELECT") > 1).cast("int"),
        "has_group_by": up.contains("GROUP BY").cast("int"),
        "has_order_by_no_limit": (up.contains("ORDER BY") & ~up.contains("LIMIT")).cast("int"),
        "has_or": up.contains(" OR ").cast("int"),
        "has_function_in_where": called.cast("int"),
    }


def fill_placeholders(query: Column) -> Column:
    """$1, $2, ... become 1, so that the statement can be planned."""
    return F.regexp_replace(query, r"\$\d+", "1")


def is_candidate(sql: Column) -> Column:
    """Starts with SELECT and contains FROM; a leading WITH is not accepted. NULL is invalid."""
    up = F.upper(strip(sql))
    return F.coalesce(up.startswith("SELECT") & up.contains("FROM"), F.lit(False))


def answer_sql(raw: Column) -> Column:
    """The SQL inside a generated answer, or NULL if it is not a SELECT."""
    body = F.substring_index(raw, ANSWER_MARK, -1)
    body = strip(F.regexp_replace(body, r"(?i)```sql|```", ""))
    # up to the first line that ends in a semicolon
    body = F.regexp_replace(body, r"(?s)\A(.*?;)[ \t\r]*(?:\n.*)?\z", "$1")
    body = F.regexp_replace(strip(body), r"[;\s]+\z", "")
    body = F.regexp_replace(body, r"(?is)\s+OFFSET\s+0\b.*\z", "")
    return F.nullif(F.regexp_extract(body, r"(?is)\A(SELECT.*)\z", 1), F.lit(""))


def clean_candidate(sql: Column) -> Column:
    """A valid candidate with JOINS corrected to JOIN, else NULL."""
    fixed = F.regexp_replace(strip(sql), r"(?i)\bJOINS\b", "JOIN")
    return F.nullif(F.regexp_extract(fixed, r"(?is)\A(SELECT.*FROM.*)\z", 1), F.lit(""))


def strategy(original: Column, rewritten: Column) -> Column:
    """What a rewrite did; the first rule that applies names it."""
    old, new = F.upper(original), F.upper(rewritten)
    nested = occurrences(old, "SELECT") > 1
    return (
        F.when(old.contains("SELECT *") & ~new.contains("SELECT *"), DROP_STAR)
        .when(nested & new.contains("JOIN") & new.contains("GROUP BY"), TO_JOIN)
        .when(nested & (occurrences(new, "SELECT") <= occurrences(old, "SELECT")), TO_JOIN)
        .when(occurrences(new, "JOIN") < occurrences(old, "JOIN"), FEWER_JOINS)
        .when(new.contains("WHERE") & ~old.contains("WHERE"), ADD_WHERE)
        .when(new.contains("LIMIT") & ~old.contains("LIMIT"), ADD_LIMIT)
        .otherwise(OTHER)
    )


def optimisation_flags(slow: Column, predicted: Column) -> dict[str, Column]:
    old, new = F.upper(slow), F.upper(predicted)
    flags = {  # fixed values: the names of the flags and what each looks for
        "removed_select_star": old.contains("SELECT *") & ~new.contains("SELECT *"),
        "added_limit": ~old.contains("LIMIT") & new.contains("LIMIT"),
        "added_where": ~old.contains("WHERE") & new.contains("WHERE"),
        "reduced_joins": occurrences(old, "JOIN") > occurrences(new, "JOIN"),
        "used_ilike": old.contains("LIKE") & new.contains("ILIKE"),
    }
    found = F.lit(False)
    for flag in flags.values():
        found = found | flag
    return {**flags, "any_optimization": found}


def clean_pair_text(sql: Column) -> Column:
    """Without HTML entities, decoding artefacts of `id`, and non-ASCII characters."""
    # fixed values: the pattern of an entity, and the aliases whose `.id` was decoded as `.99`
    out = F.regexp_replace(sql, "&[a-zA-Z]+;", "")
    for alias in ("u", "p", "v"):
        out = F.replace(out, F.lit(f"{alias}.99"), F.lit(f"{alias}.id"))
    return strip(F.regexp_replace(out, r"[^\x00-\x7F]", ""))
