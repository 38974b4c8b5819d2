"""Window shapes of the workload, written so that one huge partition stays parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.operators.ordered import join_on, running_sums


def running_total(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """SUM(value) OVER (PARTITION BY key ORDER BY order): peers share the total up to their last."""
    peers = df.groupBy(key, order).agg(F.sum(value).alias("peer__"))
    totals = running_sums(peers, [key], [F.col(order).asc_nulls_last()], {name: F.col("peer__")}).drop("peer__")
    return join_on(df, totals, [key, order])


def group_average(df: DataFrame, key: str, value: str, average: str, difference: str) -> DataFrame:
    """The mean of the row's group and the distance from it."""
    means = df.groupBy(F.col(key).alias("key__")).agg(F.avg(value).alias(average))
    return (
        df.join(means, F.col(key).eqNullSafe(F.col("key__")))
        .drop("key__")
        .withColumn(difference, F.col(value) - F.col(average))
    )


def leader(df: DataFrame, key: str, value: str, ident: str, shown: str, name: str) -> DataFrame:
    """FIRST_VALUE(shown) by `value` descending within the key, nulls first as in PostgreSQL; the smallest `ident` wins ties."""
    ties = df.groupBy(F.col(key).alias("key__"), F.col(value).alias("value__")).agg(F.min_by(F.struct(F.col(shown).alias("s")), F.struct(ident)).alias("shown__"))
    order = F.struct(F.col("value__").isNull().alias("missing"), "value__")
    best = ties.groupBy("key__").agg(F.max_by("shown__", order).alias("best__")).select("key__", F.col("best__.s").alias(name))
    return df.join(best, F.col(key).eqNullSafe(F.col("key__"))).drop("key__")
