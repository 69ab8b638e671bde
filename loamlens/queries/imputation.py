"""Group-aware imputation, fitted on one part of the rows and applied to all."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.operators.impute import (
    GroupedMedianImputer, GroupedMostFrequentImputer, GroupwiseImputer)
from loamlens.queries.inputs import RECORD_KEY
from loamlens.queries.registry import query, rounded, table


def gappy_lines(spark, sf_dir):
    """Line items with missing numbers, categories and groups; NATION_3 has no quantity at all."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            *RECORD_KEY, F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("state_name"),
            F.when((F.col("l_discount") != 0) & (F.col("n_name") != "NATION_3"),
                   F.col("l_quantity")).alias("quantity"),
            F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("price"),
            F.when(F.col("l_discount") != 0.1, F.col("l_returnflag")).alias("flag"),
            (F.col("l_linestatus") == "F").alias("seen"))
    )


def seen(lines):
    """The rows to fit on. NATION_7 is not among them."""
    return lines.where(F.col("seen") & (F.coalesce("state_name", F.lit("")) != "NATION_7"))


GAPPY_SQL = """
gappy AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN s_acctbal >= 0 THEN n_name END AS state_name,
         CASE WHEN l_discount <> 0 AND n_name <> 'NATION_3' THEN l_quantity END AS quantity,
         CASE WHEN l_tax <> 0 THEN l_extendedprice END AS price,
         CASE WHEN l_discount <> 0.1::DOUBLE THEN l_returnflag END AS flag,
         l_linestatus = 'F' AS seen
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
fitted AS (SELECT * FROM gappy WHERE seen AND coalesce(state_name, '') <> 'NATION_7'),
medians AS (
  SELECT state_name, median(quantity) AS quantity, median(price) AS price
  FROM fitted WHERE state_name IS NOT NULL GROUP BY state_name),
global_medians AS (SELECT median(quantity) AS quantity, median(price) AS price FROM fitted),
flags AS (
  SELECT state_name, flag FROM fitted WHERE state_name IS NOT NULL AND flag IS NOT NULL
  GROUP BY state_name, flag
  QUALIFY row_number() OVER (PARTITION BY state_name ORDER BY count(*) DESC, flag) = 1),
global_flag AS (
  SELECT flag FROM fitted WHERE flag IS NOT NULL
  GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
global_state AS (
  SELECT state_name FROM fitted WHERE state_name IS NOT NULL
  GROUP BY state_name ORDER BY count(*) DESC, state_name LIMIT 1)"""


@query(f"""
WITH {GAPPY_SQL}
SELECT g.l_orderkey, g.l_linenumber, g.l_partkey, g.l_suppkey,
       round(coalesce(g.quantity, m.quantity, (SELECT quantity FROM global_medians)), 6) AS quantity
FROM gappy g LEFT JOIN medians m ON g.state_name = m.state_name
""")
def impute_median(spark, sf_dir):
    lines = gappy_lines(spark, sf_dir)
    model = GroupedMedianImputer("state_name", "quantity").fit(seen(lines))
    return model.transform(lines).select(*RECORD_KEY, rounded("quantity"))


@query(f"""
WITH {GAPPY_SQL}
SELECT g.l_orderkey, g.l_linenumber, g.l_partkey, g.l_suppkey,
       coalesce(g.flag, m.flag, (SELECT flag FROM global_flag)) AS flag
FROM gappy g LEFT JOIN flags m ON g.state_name = m.state_name
""")
def impute_mode(spark, sf_dir):
    lines = gappy_lines(spark, sf_dir)
    model = GroupedMostFrequentImputer("state_name", "flag").fit(seen(lines))
    return model.transform(lines).select(*RECORD_KEY, "flag")


@query(f"""
WITH {GAPPY_SQL}
SELECT g.l_orderkey, g.l_linenumber, g.l_partkey, g.l_suppkey,
       round(coalesce(g.quantity, m.quantity, (SELECT quantity FROM global_medians)), 6) AS quantity,
       round(coalesce(g.price, m.price, (SELECT price FROM global_medians)), 6) AS price,
       coalesce(g.flag, f.flag, (SELECT flag FROM global_flag)) AS flag,
       coalesce(g.state_name, (SELECT state_name FROM global_state)) AS state_name
FROM gappy g
LEFT JOIN medians m ON g.state_name = m.state_name
LEFT JOIN flags f ON g.state_name = f.state_name
""")
def impute_all(spark, sf_dir):
    lines = gappy_lines(spark, sf_dir)
    imputer = GroupwiseImputer("state_name", ["quantity", "price", "not_there"],
                               ["flag", "state_name"])
    return imputer.fit(seen(lines)).transform(lines).select(
        *RECORD_KEY, rounded("quantity"), rounded("price"), "flag", "state_name")
