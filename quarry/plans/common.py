"""Driver-table stand-ins shared by the plan modules (FIXTURES.md §3).

Every stand-in is a lazy expression over the driver tables, so each
registered query's work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.tables import Tables

OUTCOME_DOMAIN = [0, 1, 2, 3, 4]
# SQL spelling of the same stand-in, used by the oracles.
OUTCOME_SQL = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1"


def outcome(col: str = "o_orderpriority") -> Column:
    """Ordered outcome 0-4 from the order priority ('1-URGENT' → 0)."""
    return (F.substring(F.col(col), 1, 1).cast("int") - F.lit(1)).alias("outcome")


def orders_by_nation(t: Tables) -> DataFrame:
    """(n_name, outcome, n): order counts per customer nation and outcome.

    Orders are pre-aggregated per (customer, outcome) before the customer
    join, so the shuffle moves at most five rows per customer instead of
    every order; a hot customer is combined map-side.
    """
    per_cust = (t.orders.select("o_custkey", outcome())
                .groupBy("o_custkey", "outcome").agg(F.count(F.lit(1)).alias("n")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = per_cust.join(cust, "o_custkey").join(nation, "c_nationkey", "left")
    return joined.select(F.coalesce("n_name", F.lit("Unknown")).alias("n_name"), "outcome", "n")


ORDERS_BY_NATION_SQL = f"""
  SELECT coalesce(n.n_name, 'Unknown') AS n_name, {OUTCOME_SQL} AS outcome
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
