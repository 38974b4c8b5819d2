"""Ordered computations that stay balanced when one key, or no key at all, holds most rows.

A plain window puts all rows of a key into one task. Here the rows are range-partitioned on
(keys, order), so a hot key is spread over many slices; each slice is worked on alone and what
came before it is added from a table with at most one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.session import materialize

SLICE = "slice__"


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Number the range slices and fix them on shared storage, so each later pass sees the same ones.

    Adaptive execution sizes the slices: it merges neighbours of the shuffle partitions, which keeps
    their order.
    """
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def _carry(cut: DataFrame, keys: Sequence[str], summary: dict[str, Column], over: dict[str, callable]) -> DataFrame:
    """One row for every slice that continues a key begun in an earlier slice.

    Ranges are ordered by key first, so a slice continues at most one key: the result never has
    more rows than there are slices, however many keys or rows there are.
    """
    per_slice = cut.groupBy(*keys, SLICE).agg(*[c.alias(n) for n, c in summary.items()])
    earlier = Window.partitionBy(*keys).orderBy(SLICE)
    rows = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_slice.select(
            *keys,
            SLICE,
            F.count("*").over(rows).alias("earlier__"),
            *[make(F.col(n), earlier, rows).alias(n) for n, make in over.items()],
        )
        .filter("earlier__ > 0")
        .drop("earlier__")
    )


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in GROUP BY and PARTITION BY."""
    renamed = right.withColumnsRenamed({k: f"right_{k}__" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"right_{k}__"))
    return left.join(renamed, same, how).drop(*[f"right_{k}__" for k in keys])


def _attach(cut: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = carry.select(
        F.col(SLICE).alias("carry_slice__"),
        *[F.col(k).alias(f"carry_{k}__") for k in keys],
        *[c for c in carry.columns if c not in (*keys, SLICE)],
    )
    same = F.col(SLICE) == F.col("carry_slice__")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"carry_{k}__"))
    return cut.join(F.broadcast(renamed), same, "left").drop("carry_slice__", *[f"carry_{k}__" for k in keys])


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, Column]
) -> DataFrame:
    """Add, per row, the sum of each expression over the rows of its keys up to and including it.

    `order` must be unique within the keys.
    """
    base = df.select("*", *[c.alias(f"in_{n}__") for n, c in sums.items()])
    cut = _cut(base, keys, order)
    carry = _carry(
        cut,
        keys,
        {f"before_{n}__": F.sum(f"in_{n}__") for n in sums},
        {f"before_{n}__": (lambda c, _w, rows: F.sum(c).over(rows)) for n in sums},
    )
    inside = Window.partitionBy(SLICE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return _attach(cut, carry, keys).select(
        *df.columns,
        *[
            # an all-null prefix stays null, as in a SQL running SUM
            F.when(
                F.sum(f"in_{n}__").over(inside).isNull() & F.col(f"before_{n}__").isNull(), None
            )
            .otherwise(
                F.coalesce(F.sum(f"in_{n}__").over(inside), F.lit(0)) + F.coalesce(f"before_{n}__", F.lit(0))
            )
            .alias(n)
            for n in sums
        ],
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """ROW_NUMBER per key as bigint; `order` must be unique within the keys."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("bigint")})


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """LAG(value, 1) per key by ascending order columns, unique together; nulls come last, as in PostgreSQL."""
    by = [F.col(o).asc_nulls_last() for o in order]
    cut = _cut(df, keys, by)
    place = F.struct(*[x for i, o in enumerate(order) for x in (F.col(o).isNull().alias(f"null{i}"), F.col(o).alias(f"at{i}"))])
    carry = _carry(
        cut,
        keys,
        {"carry_value__": F.max_by(F.struct(value), place)},
        {"carry_value__": (lambda c, earlier, _rows: F.lag(c).over(earlier))},
    )
    inside = Window.partitionBy(SLICE, *keys).orderBy(*by)
    return _attach(cut, carry, keys).select(
        *df.columns,
        F.when(F.row_number().over(inside) == 1, F.col(f"carry_value__.{value}"))
        .otherwise(F.lag(value).over(inside))
        .alias(name),
    )


def ntile(df: DataFrame, order: Sequence[Column], tiles: int, name: str) -> DataFrame:
    """Global NTILE: sizes differ by at most one, the larger tiles come first."""
    total = df.agg(F.count("*").alias("n")).scalar()
    placed = positions(df, [], order, "place__").withColumn("rows__", total)
    small = F.floor(F.col("rows__") / tiles)
    larger = F.col("rows__") % tiles
    index = F.col("place__") - 1
    edge = larger * (small + 1)
    return placed.select(
        *df.columns,
        F.when(index < edge, F.floor(index / (small + 1)) + 1)
        .otherwise(larger + F.floor((index - edge) / F.greatest(small, F.lit(1))) + 1)
        .cast("bigint")
        .alias(name),
    )


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key, without gathering a key's values in one place.

    Equal values are counted first, which is the only pass over `df`; the counts lie in range slices.
    One row per key and slice gives what came before the slice and the size of the key, so only the
    slices that hold a wanted place are read again and put in order.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("same__"))
    )
    cut = _cut(counts, keys, [F.col(value)])
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        cut.groupBy(*keys, SLICE)
        .agg(F.sum("same__").alias("here__"))
        .withColumn("rows__", F.sum("here__").over(whole))
        .withColumn("before__", F.coalesce(F.sum("here__").over(earlier), F.lit(0)))
    )
    last = F.col("rows__") - 1
    wanted = F.lit(False)
    for p in probs.values():
        for place in (F.floor(last * F.lit(float(p))), F.ceil(last * F.lit(float(p)))):
            wanted = wanted | ((F.col("before__") <= place) & (place < F.col("before__") + F.col("here__")))
    # keys meet as one struct, in which nulls are equal; the window keeps the partitioning of the join
    key = F.struct(*keys) if keys else F.lit(0)
    found = slices.filter(wanted).select(F.col(SLICE).alias("found_slice__"), key.alias("found_key__"), "rows__", "before__")
    same = (F.col(SLICE) == F.col("found_slice__")) & (F.col("key__") == F.col("found_key__"))
    inside_slice = Window.partitionBy(SLICE, "key__").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    sized = (
        cut.withColumn("key__", key)
        .join(found, same)
        .withColumn("upto__", F.col("before__") + F.sum("same__").over(inside_slice))
    )

    def at(place: Column) -> Column:
        inside = (F.col("upto__") - F.col("same__") <= place) & (place < F.col("upto__"))
        return F.max(F.when(inside, F.col(value)))

    picked = []
    for name, p in probs.items():
        place = last * F.lit(float(p))
        picked += [
            at(F.floor(place)).alias(f"low_{name}__"),
            at(F.ceil(place)).alias(f"high_{name}__"),
            F.max(place - F.floor(place)).alias(f"part_{name}__"),
        ]
    out = sized.groupBy(*keys).agg(*picked)
    return out.select(
        *keys,
        *[
            # half way is the mean of both, as in a median
            F.when(F.col(f"part_{n}__") == 0.5, (F.col(f"low_{n}__") + F.col(f"high_{n}__")) / 2)
            .otherwise(F.col(f"low_{n}__") + (F.col(f"high_{n}__") - F.col(f"low_{n}__")) * F.col(f"part_{n}__"))
            .alias(n)
            for n in probs
        ],
    )


def rank_at_most(df: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """Rows whose RANK() by `value` descending (nulls first) is at most k, with that rank.

    A row qualifies if its value is at least the k-th largest one. Ranks come from the counts of
    the at most k distinct values above the cut, so no window runs over the whole table.
    """
    top = df.select(value).orderBy(F.col(value).desc_nulls_first()).limit(k)
    kept = (
        df.withColumn("cut__", top.agg(F.min(value)).scalar())
        .filter(F.col(value).isNull() | (F.col(value) >= F.col("cut__")))
        .drop("cut__")
    )
    counts = kept.groupBy(value).agg(F.count("*").alias("same__"))
    above = Window.orderBy(F.col(value).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(
        F.col(value).alias("rank_value__"),
        (F.coalesce(F.sum("same__").over(above), F.lit(0)) + 1).cast("bigint").alias(name),
    )
    return kept.join(F.broadcast(ranks), F.col(value).eqNullSafe(F.col("rank_value__"))).drop("rank_value__")
