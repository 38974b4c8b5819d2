"""Columns over numbers and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range a predicted log time is clipped to.
LOG_MS_LOW, LOG_MS_HIGH = -1.0, 9.21


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def log_ms_to_ms(log_ms: Column) -> Column:
    return F.expm1(clip(log_ms, LOG_MS_LOW, LOG_MS_HIGH))


def log10_floor(x: Column, low: float) -> Column:
    """log10 with values below `low` raised to it."""
    return F.log10(F.greatest(x, F.lit(low)))


def parse_runs(text: Column) -> Column:
    """"1.50;2.25" -> [1.5, 2.25]."""
    return F.transform(F.split(text, ";"), lambda x: x.try_cast("double"))


def format_runs(runs: Column) -> Column:
    """[1.5, 2.25] -> "1.50;2.25"."""
    return F.array_join(F.transform(runs, lambda x: F.format_string("%.2f", x)), ";")


def _doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when a vector has zero length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def half_even(x: Column, digits: int) -> Column:
    """Rounded like Python's round(): by the exact binary value, true ties to the even digit.

    bround() decides by the shortest decimal text instead, which differs near ties. The product
    with the power of ten is therefore taken together with its rounding error.
    """
    if digits == 0:
        return F.bround(x, 0)
    power = F.lit(float(10**digits))

    def rounded(v):
        big = v["x"] * 134217729.0
        return let(
            F.struct(v["x"].alias("x"), (v["x"] * power).alias("scaled"), (big - (big - v["x"])).alias("upper")),
            chosen,
        )

    def chosen(v):
        error = (v["upper"] * power - v["scaled"]) + (v["x"] - v["upper"]) * power
        return let(
            F.struct(
                F.floor(v["scaled"]).cast("double").alias("below"),
                ((v["scaled"] - (F.floor(v["scaled"]) + 0.5)) + error).alias("over"),
            ),
            lambda w: (w["below"] + ((w["over"] > 0) | ((w["over"] == 0) & (w["below"] % 2 != 0))).cast("int")) / power,
        )

    return let(F.struct(x.cast("double").alias("x")), rounded)
