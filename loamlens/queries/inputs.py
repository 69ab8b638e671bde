"""Inputs of the operators, made from the given tables.

The tables have no missing values and no dirty text, so both are put in by rules on the data. Each
input exists twice: as a DataFrame and as the SQL that yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamlens.queries.registry import table

# The part types that play the five wanted commodities (ECONOMY is not wanted).
PART_COMMODITIES = ("STANDARD", "MEDIUM", "PROMO", "SMALL", "LARGE")
COMMODITY_SQL = "('STANDARD', 'MEDIUM', 'PROMO', 'SMALL', 'LARGE')"
RECORD_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
RECORD_ORDER = ("commodity_desc", "yield_value", "unit_desc", *RECORD_KEY)


def crop_records(spark: SparkSession, sf_dir: str, unit: int = 1) -> DataFrame:
    """Line items as raw yield records: dirty value and year, untidy and missing names."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    amount = F.floor(F.col("l_extendedprice") / unit).cast("bigint")
    thousands = F.concat(F.expr("CAST(amount div 1000 AS STRING)"), F.lit(","),
                         F.lpad(F.expr("CAST(amount % 1000 AS STRING)"), 3, "0"))
    text = F.col("amount").cast("string")
    value = (F.when(F.col("l_discount") == 0, F.lit("(D)"))
             .when(F.col("l_tax") == 0, F.concat(F.lit("-"), text))
             .when(F.col("amount") >= 1000, thousands)
             .otherwise(F.concat(text, F.lit(" (H)"))))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("amount", amount)
        .select(
            F.col("p_type").alias("commodity_desc"),
            F.when(F.col("l_returnflag") == "N", "AREA").otherwise("YIELD")
            .alias("statisticcat_desc"),
            F.when(F.col("l_discount") == 0.1, "n/a")
            .otherwise(F.year("l_shipdate").cast("string")).alias("year"),
            value.alias("value"),
            F.when(F.col("s_acctbal") >= 0,
                   F.concat(F.lit("\t"), F.lower("n_name"), F.lit(" \n"))).alias("state_name"),
            F.concat(F.lit(" "), F.col("p_brand")).alias("county_name"),
            F.col("l_linestatus").alias("unit_desc"), *RECORD_KEY)
    )


def crop_sql(unit: int = 1) -> str:
    """``crops``: the raw records, and ``parsed``: the same with parsed value, year and names."""
    return rf"""
crops AS (
  SELECT p_type AS commodity_desc,
         CASE WHEN l_returnflag = 'N' THEN 'AREA' ELSE 'YIELD' END AS statisticcat_desc,
         CASE WHEN l_discount = 0.1::DOUBLE THEN 'n/a'
              ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year,
         CASE WHEN l_discount = 0 THEN '(D)'
              WHEN l_tax = 0 THEN '-' || CAST(amount AS VARCHAR)
              WHEN amount >= 1000 THEN CAST(amount // 1000 AS VARCHAR) || ','
                                       || lpad(CAST(amount % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(amount AS VARCHAR) || ' (H)' END AS value,
         CASE WHEN s_acctbal >= 0 THEN chr(9) || lower(n_name) || ' ' || chr(10) END AS state_name,
         ' ' || p_brand AS county_name, l_linestatus AS unit_desc,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM (SELECT *, CAST(floor(l_extendedprice / {unit}) AS BIGINT) AS amount FROM lineitem)
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
parsed AS (
  SELECT commodity_desc, statisticcat_desc, TRY_CAST(year AS INTEGER) AS year,
         TRY_CAST(regexp_replace(value, '[^0-9.]', '', 'g') AS DOUBLE) AS yield_value,
         upper(regexp_replace(state_name, '^\s+|\s+$', '', 'g')) AS state_name,
         upper(regexp_replace(county_name, '^\s+|\s+$', '', 'g')) AS county_name,
         unit_desc, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM crops
)"""


def order_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as samples: the state of the customer (missing for debtors), the year of the order."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey",
                F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("state_name"),
                F.year("o_orderdate").alias("sample_year"))
    )


SAMPLE_SQL = """
samples AS (
  SELECT o_orderkey, o_custkey, CASE WHEN c_acctbal >= 0 THEN n_name END AS state_name,
         CAST(year(o_orderdate) AS INTEGER) AS sample_year
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a mixed feature set: missing numbers and categories, a constant column."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customers = table(spark, sf_dir, "customer")
    return (
        customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("nation"),
            F.col("n_regionkey").alias("fold"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
            F.col("n_orders").cast("double").alias("n_orders"),
            F.lit(7.0).alias("constant"),
            F.when(F.col("c_acctbal") < 9500, F.col("c_mktsegment")).alias("segment"))
    )


CUSTOMER_SQL = """
customers AS (
  SELECT c_custkey AS row_id, c_nationkey AS nation, n_regionkey AS fold,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         CAST(n_orders AS DOUBLE) AS n_orders, 7.0::DOUBLE AS constant,
         CASE WHEN c_acctbal < 9500 THEN c_mktsegment END AS segment
  FROM customer
  LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
    ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""
CUSTOMER_NUMERIC = ("balance", "n_orders", "constant")
CUSTOMER_CATEGORICAL = ("segment",)


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with duplicated feature vectors; the target is the mean quantity sold."""
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.avg("l_quantity").alias("y"))
    return (
        table(spark, sf_dir, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"))
        .select(F.col("p_partkey").alias("row_id"), "p_size", "p_brand", "p_type", "y")
    )


PART_SQL = """
parts AS (
  SELECT p_partkey AS row_id, p_size, p_brand, p_type, y
  FROM part JOIN (SELECT l_partkey, avg(l_quantity) AS y FROM lineitem GROUP BY l_partkey)
    ON p_partkey = l_partkey
)"""
PART_NUMERIC = ("p_size",)
PART_CATEGORICAL = ("p_brand", "p_type")


def local_variance_sql(source: str, name: str = "local") -> str:
    """Local variance of the rows of ``source``, a relation like ``parts``."""
    return f"""
{name}_width AS (SELECT max(p_size) - min(p_size) AS w FROM {source}),
{name}_pairs AS (
  SELECT a.row_id, b.row_id AS other, b.y,
         coalesce(abs(a.p_size - b.p_size) / nullif(w, 0)::DOUBLE, 0) / 3
         + ((CASE WHEN a.p_brand <> b.p_brand THEN 1 ELSE 0 END)
            + (CASE WHEN a.p_type <> b.p_type THEN 1 ELSE 0 END)) / 3.0::DOUBLE AS d
  FROM {source} a JOIN {source} b ON a.row_id <> b.row_id CROSS JOIN {name}_width
),
{name}_top AS (
  SELECT row_id, y FROM {name}_pairs WHERE d > 0
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY round(d, 12), other) <= 10
),
{name} AS (
  SELECT p.row_id, v.local_var
  FROM {source} p
  LEFT JOIN (SELECT row_id, var_samp(y) AS local_var FROM {name}_top GROUP BY row_id) v
    ON p.row_id = v.row_id
)"""


def folds_sql(source: str, group: str, kind: str, name: str = "folds") -> str:
    """``(group, group_rows, fold)`` by dealing one group after the other to the lightest fold."""
    return f"""
{name}_groups AS (
  SELECT {group} AS grp, count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, md5('42|' || CAST({group} AS VARCHAR))) AS i
  FROM {source} GROUP BY {group}
),
{name}_dealt(i, grp, n, fold, loads) AS (
  SELECT 0::BIGINT, CAST(NULL AS {kind}), 0::BIGINT, 0::BIGINT,
         [0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT]
  UNION ALL
  SELECT g.i, g.grp, g.n, f.fold,
         list_transform([0, 1, 2, 3, 4],
                        lambda x: d.loads[x + 1] + CASE WHEN x = f.fold THEN g.n ELSE 0 END)
  FROM {name}_dealt d
  JOIN {name}_groups g ON g.i = d.i + 1
  CROSS JOIN LATERAL (SELECT list_position(d.loads, list_min(d.loads)) - 1 AS fold) f
),
{name} AS (
  SELECT grp AS {group}, n AS group_rows, CAST(fold AS INTEGER) AS fold
  FROM {name}_dealt WHERE i > 0
)"""


def holdout_sql(source: str, group: str, name: str = "held") -> str:
    """``(group, is_holdout)`` of the groups of ``source``."""
    return f"""
{name} AS (
  SELECT {group}, rank <= ceil(n * 0.2::DOUBLE) AS is_holdout
  FROM (SELECT {group}, row_number() OVER (ORDER BY md5('42|' || CAST({group} AS VARCHAR))) AS rank,
               count(*) OVER () AS n
        FROM (SELECT DISTINCT {group} FROM {source}))
)"""
