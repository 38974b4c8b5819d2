"""Features of a plan document: a JSON tree of any shape and depth.

Documents come in Arrow batches and each is read in one pass: the parsed tree is walked with a list of open nodes that
adds up counts and flags, so its depth is no limit. Documents nested too deeply for the JSON library's own recursion are
parsed from their tokens. Array functions over variants, which this replaces, had to list each level again and took
several times as long.
"""

from __future__ import annotations

import json
import math
import re
from functools import cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from slowtide.session import ship

# The plan features, in the order the models expect them.
PLAN_FEATURES = [
    "plan_total_cost", "plan_rows", "actual_rows", "plan_depth", "shared_hit", "shared_read",
    "has_seq_scan", "has_index_scan", "has_bitmap_scan", "has_hash_join", "has_nested_loop", "has_merge_join",
]
# Node type substrings behind each flag.
NODE_FLAGS = {
    "has_seq_scan": ["Seq Scan"],
    "has_index_scan": ["Index Scan", "Index Only Scan"],
    "has_bitmap_scan": ["Bitmap"],
    "has_hash_join": ["Hash Join"],
    "has_nested_loop": ["Nested Loop"],
    "has_merge_join": ["Merge Join"],
}


_LARGEST = 2**63
_TOKEN = re.compile(r'\s*(?:([{}\[\]:,])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)|(true|false|null))')


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _parse_deep(text: str):
    """The value of a JSON text of any depth, built from its tokens with an explicit list of open containers."""
    open_: list = []
    whole, expected, at = [], "value", 0
    while at < len(text):
        token = _TOKEN.match(text, at)
        if token is None:
            if text[at:].strip():
                raise ValueError("not a token")
            break
        at = token.end()
        mark = token[1]
        if mark in ("}", "]"):
            if not open_ or expected not in ("next", "first") or (mark == "}") != isinstance(open_[-1][0], dict):
                raise ValueError("unexpected end")
            open_.pop()
            expected = "next"
            continue
        if mark == ",":
            if expected != "next" or not open_:
                raise ValueError("unexpected comma")
            expected = "key" if isinstance(open_[-1][0], dict) else "value"
            continue
        if open_ and isinstance(open_[-1][0], dict) and expected in ("first", "key"):
            if token[2] is None:
                raise ValueError("a key is missing")
            open_[-1][1] = json.loads(token[2])
            expected = "colon"
            continue
        if mark == ":":
            if expected != "colon":
                raise ValueError("unexpected colon")
            expected = "value"
            continue
        if expected not in ("value", "first"):
            raise ValueError("unexpected value")
        value = {} if mark == "{" else [] if mark == "[" else json.loads(token[0])
        if not open_:
            whole.append(value)
        elif isinstance(open_[-1][0], dict):
            open_[-1][0][open_[-1][1]] = value
        else:
            open_[-1][0].append(value)
        if mark:
            open_.append([value, None])
        expected = "first" if mark else "next"
    if open_ or len(whole) != 1:
        raise ValueError("cut off")
    return whole[0]


def _number(value, whole: bool = True):
    """A number, text that holds one, or 0."""
    try:
        found = float(value) if not isinstance(value, int) or not whole else int(value)
    except (TypeError, ValueError, OverflowError):
        return 0
    if not whole:
        return found
    return int(found) if math.isfinite(found) and -_LARGEST <= found < _LARGEST else 0


def _read_one(text: str | None) -> tuple:
    """The twelve features and whether there is a text that cannot be read."""
    nothing = (0.0, 0, 0, 0, 0, 0, *[0] * len(NODE_FLAGS))
    if text is None:
        return *nothing, False
    try:
        try:
            document = json.loads(text, parse_constant=_no_constant)
        except RecursionError:
            document = _parse_deep(text)
    except ValueError:
        return *nothing, True
    # the document is {"Plan": node}, a list holding that, or the node itself
    outer = document[0] if isinstance(document, list) and document else document
    root = outer["Plan"] if isinstance(outer, dict) and "Plan" in outer else document
    if not isinstance(root, dict):
        return *nothing, False
    hit = read = deepest = 0
    kinds = set()
    rest = [(root, 0)]
    while rest:
        node, depth = rest.pop()
        deepest = max(deepest, depth)
        if not isinstance(node, dict):
            continue
        kinds.add(str(node.get("Node Type", "")))
        hit += _number(node.get("Shared Hit Blocks", 0))
        read += _number(node.get("Shared Read Blocks", 0))
        below = node.get("Plans")
        if isinstance(below, list):
            rest += [(child, depth + 1) for child in below]
    flags = [int(any(p in k for k in kinds for p in pieces)) for pieces in NODE_FLAGS.values()]
    return float(_number(root.get("Total Cost", 0), False)), _number(root.get("Plan Rows", 0)), _number(root.get("Actual Rows", 0)), deepest, hit, read, *flags, False


_KINDS = "plan_total_cost double, plan_rows bigint, actual_rows bigint, plan_depth int, shared_hit bigint, shared_read bigint, " + ", ".join(f"{n} int" for n in NODE_FLAGS)


@cache
def _reader():
    names = [*PLAN_FEATURES, "plan_rejected"]

    def read(documents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_read_one(d) for d in documents], columns=names)

    read.__annotations__ = {"documents": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(read, f"{_KINDS}, plan_rejected boolean")


def _read(document: Column) -> Column:
    ship(SparkSession.active())
    return _reader()(document)


def plan_features(document: Column) -> Column:
    """A struct of the twelve features; block counts are summed over all nodes.

    A missing or malformed document gives zeros; `plan_rejected` tells them apart. Spark reads a document once where a
    query asks for both.
    """
    read = _read(document)
    return F.struct(*[read[f].alias(f) for f in PLAN_FEATURES])


def plan_rejected(document: Column) -> Column:
    """Whether there is a document that is malformed. Such rows belong into a quarantine, since their features are zeros."""
    return _read(document)["plan_rejected"]
