"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.operators.lookup import lookup, unmatched
from loamlens.queries.registry import query, table


def _lookups(spark, sf_dir):
    """Orders with their customer and nation; debtors and two regions are not in the lookups."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("label"))
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") < 3).select(
        "n_nationkey", F.col("n_name").alias("state_name"), F.col("n_regionkey").alias("label"))
    first = lookup(orders, customers, "o_custkey", "c_custkey", "_customer")
    return lookup(first, nations, "c_nationkey", "n_nationkey", "_nation")


LOOKUP_SQL = """
looked_up AS (
  SELECT o_orderkey, o_custkey, o_orderpriority AS label, c_nationkey,
         c_mktsegment AS label_customer, n_name AS state_name, n_regionkey AS label_nation
  FROM orders
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey
)"""


@query(f"WITH {LOOKUP_SQL} SELECT * EXCLUDE (c_nationkey) FROM looked_up")
def lookup_join(spark, sf_dir):
    return _lookups(spark, sf_dir).drop("c_nationkey")


@query(f"""
WITH {LOOKUP_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE state_name IS NULL) AS n_unmatched
FROM looked_up
""")
def lookup_unmatched(spark, sf_dir):
    return unmatched(_lookups(spark, sf_dir), "state_name")


@query("""
SELECT p_partkey, p_brand, l_orderkey, l_linenumber, l_suppkey, l_quantity
FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
  ON p_partkey = l_partkey
""")
def lookup_fanout(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return lookup(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), returned,
                  "p_partkey", "l_partkey")


def _keyed(spark, sf_dir):
    """Customers without a key for debtors, and per-nation balances with one for the debtors."""
    customers = table(spark, sf_dir, "customer")
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    base = customers.select("c_custkey", key.alias("state"))
    balances = customers.groupBy(key.alias("nation")).agg(F.count(F.lit(1)).alias("n_customers"))
    return base, balances


NULL_KEY_SQL = """
keyed AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS state FROM customer),
balances AS (SELECT state AS nation, count(*) AS n_customers FROM keyed GROUP BY state)"""


@query(f"""
WITH {NULL_KEY_SQL}
SELECT c_custkey, state, n_customers FROM keyed LEFT JOIN balances ON state = nation
""")
def lookup_null_keys(spark, sf_dir):
    base, balances = _keyed(spark, sf_dir)
    return lookup(base, balances, "state", "nation")


@query(f"""
WITH {NULL_KEY_SQL}
SELECT c_custkey, state, n_customers
FROM keyed LEFT JOIN balances ON state IS NOT DISTINCT FROM nation
""")
def lookup_matching_nulls(spark, sf_dir):
    base, balances = _keyed(spark, sf_dir)
    return lookup(base, balances, "state", "nation", match_nulls=True)
