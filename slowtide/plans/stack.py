"""`users`, `posts` and `votes` derived from the customer, orders and lineitem tables.

The foreign keys run the same way: votes.post_id -> posts.id, posts.owner_user_id -> users.id.
Locations are missing in one market segment and answers (post type 2) have no title, so that the
null rules are exercised.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.sources.tables import Tables


class Stack(Tables):
    @cached_property
    def users(self) -> DataFrame:
        places = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return self.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("id"),
            F.concat(F.lower("c_mktsegment"), F.lit("_"), F.right("c_name", F.lit(3))).alias("display_name"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.concat("n_name", F.lit(", "), "r_name")).alias("location"),
            F.floor("c_acctbal").cast("int").alias("reputation"),
            F.expr("timestamp_ntz'2009-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 4000 as int))").alias("creation_date"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        kind = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
        price = F.floor("o_totalprice").cast("int")
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            kind.alias("post_type_id"),
            F.col("o_custkey").alias("owner_user_id"),
            F.when(
                F.col("o_orderstatus") != "O",
                F.concat(F.lower(F.substring("o_orderpriority", 3, 20)), F.lit(" topic "), F.col("o_custkey").cast("string")),
            ).alias("title"),
            (F.floor(F.col("o_totalprice") / 1000).cast("int") - 50).alias("score"),
            (price % 10000).alias("view_count"),
            (price % 13).alias("answer_count"),
            F.col("o_orderdate").alias("creation_date"),
        )

    @cached_property
    def votes(self) -> DataFrame:
        return self.lineitem.select(
            # lineitem has no key; with the price in cents these columns make one
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("id"),
            F.col("l_orderkey").alias("post_id"),
            F.col("l_linenumber").alias("vote_type_id"),
            F.col("l_shipdate").alias("creation_date"),
        )


_VIEWS = """users AS (
  SELECT c_custkey AS id, lower(c_mktsegment) || '_' || right(c_name, 3) AS display_name,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name || ', ' || r_name END AS location,
         CAST(floor(c_acctbal) AS INTEGER) AS reputation,
         TIMESTAMP '2009-01-01' + to_days(CAST(c_custkey % 4000 AS INTEGER)) AS creation_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
posts AS (
  SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS post_type_id,
         o_custkey AS owner_user_id,
         CASE WHEN o_orderstatus <> 'O' THEN lower(substr(o_orderpriority, 3, 20)) || ' topic ' || CAST(o_custkey AS VARCHAR) END AS title,
         CAST(floor(o_totalprice / 1000) AS INTEGER) - 50 AS score,
         CAST(floor(o_totalprice) AS INTEGER) % 10000 AS view_count,
         CAST(floor(o_totalprice) AS INTEGER) % 13 AS answer_count,
         o_orderdate AS creation_date
  FROM orders),
votes AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS id,
         l_orderkey AS post_id, l_linenumber AS vote_type_id, l_shipdate AS creation_date
  FROM lineitem)"""


def on_stack(body: str) -> str:
    """The check query `body` with the three views put in front."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {_VIEWS}, {body[5:]}"
    return f"WITH {_VIEWS} {body}"
