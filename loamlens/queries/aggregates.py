"""Aggregates with exact missing-value rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.operators.forest import best_candidate
from loamlens.operators.metrics import correlation, regression_metrics
from loamlens.operators.order_stats import (
    global_modes, grouped_modes, high_share, numeric_ranges, quantiles)
from loamlens.queries.inputs import CUSTOMER_SQL, customer_features
from loamlens.queries.registry import query, rounded, table


@query(f"""
WITH {CUSTOMER_SQL}
SELECT nation, round(median(balance), 6) AS balance, median(n_orders) AS n_orders
FROM customers GROUP BY nation
""")
def grouped_median(spark, sf_dir):
    medians = quantiles(customer_features(spark, sf_dir), ["balance", "n_orders"], 0.5, "nation")
    return medians.select("nation", rounded("balance"), "n_orders")


@query("""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS l_extendedprice,
       round(quantile_cont(l_quantity, 0.9), 6) AS l_quantity
FROM lineitem GROUP BY l_returnflag
""")
def grouped_quantile_narrowed(spark, sf_dir):
    """The way large groups take: exact quantile by narrowing intervals down."""
    high = quantiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"], 0.9,
                     "l_returnflag", buffered=40)
    return high.select("l_returnflag", rounded("l_extendedprice"), rounded("l_quantity"))


@query("""
SELECT round(quantile_cont(value, 0.9), 6) AS value, round(quantile_cont(event_id, 0.9), 6) AS event_id
FROM events
""")
def global_quantile(spark, sf_dir):
    high = quantiles(table(spark, sf_dir, "events"), ["value", "event_id"], 0.9)
    return high.select(rounded("value"), rounded("event_id"))


@query(f"""
WITH {CUSTOMER_SQL},
counts AS (SELECT nation, segment, count(*) AS n FROM customers WHERE segment IS NOT NULL
           GROUP BY nation, segment),
top AS (SELECT nation, segment FROM counts
        QUALIFY row_number() OVER (PARTITION BY nation ORDER BY n DESC, segment) = 1)
SELECT g.nation, top.segment FROM (SELECT DISTINCT nation FROM customers) g
LEFT JOIN top ON g.nation = top.nation
""")
def grouped_mode(spark, sf_dir):
    return grouped_modes(customer_features(spark, sf_dir), ["segment"], "nation")


@query("""
SELECT (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)
         AS p_brand,
       (SELECT p_type FROM part GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1) AS p_type
""")
def global_mode(spark, sf_dir):
    return global_modes(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(f"""
WITH {CUSTOMER_SQL}
SELECT 'balance' AS feature, min(balance) AS low, max(balance) AS high FROM customers
UNION ALL SELECT 'constant', min(constant), max(constant) FROM customers
UNION ALL SELECT 'n_orders', min(n_orders), max(n_orders) FROM customers
""")
def feature_ranges(spark, sf_dir):
    ranges = numeric_ranges(customer_features(spark, sf_dir), ["balance", "n_orders", "constant"])
    return spark.createDataFrame([(c, *pair) for c, pair in ranges.items()],
                                 "feature string, low double, high double")


@query(f"""
WITH {CUSTOMER_SQL}
SELECT nation, round(avg(CASE WHEN coalesce(balance > 9000, FALSE) THEN 1.0::DOUBLE
                              ELSE 0.0::DOUBLE END), 6) AS high_share,
       round(var_samp(balance), 6) AS variance, round(avg(balance), 6) AS mean,
       round(max(balance) - min(balance), 6) AS spread, count(*) AS n,
       count(*) - count(balance) AS n_missing, count(DISTINCT segment) AS n_segments
FROM customers GROUP BY nation
""")
def group_summary(spark, sf_dir):
    balance = F.col("balance")
    return customer_features(spark, sf_dir).groupBy("nation").agg(
        rounded(high_share(balance, F.lit(9000.0)), "high_share"),
        rounded(F.var_samp(balance), "variance"), rounded(F.avg(balance), "mean"),
        rounded(F.max(balance) - F.min(balance), "spread"),
        F.count(F.lit(1)).alias("n"), F.count_if(balance.isNull()).alias("n_missing"),
        F.count_distinct("segment").alias("n_segments"))


@query("""
WITH predicted AS (
  SELECT event_type, value, avg(value) OVER (PARTITION BY event_type) AS prediction FROM events)
SELECT round(sqrt(avg((value - prediction) ** 2)), 6) AS rmse,
       round(avg(abs(value - prediction)), 6) AS mae,
       round(1 - sum((value - prediction) ** 2) / (var_pop(value) * count(*)), 6) AS r2
FROM predicted
""")
def regression_scores(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    means = events.groupBy("event_type").agg(F.avg("value").alias("prediction"))
    scores = regression_metrics(events.join(F.broadcast(means), "event_type"), "value",
                                "prediction")
    return scores.select(rounded("rmse"), rounded("mae"), rounded("r2"))


@query(f"""
WITH {CUSTOMER_SQL}
SELECT fold, round(corr(balance, n_orders), 6) AS balance_orders,
       CAST(NULL AS DOUBLE) AS balance_constant
FROM customers GROUP BY fold
""")
def guarded_correlation(spark, sf_dir):
    return customer_features(spark, sf_dir).groupBy("fold").agg(
        rounded(correlation("balance", "n_orders"), "balance_orders"),
        correlation("balance", "constant").alias("balance_constant"))


@query("""
WITH scores AS (
  SELECT CAST(l_linenumber AS INTEGER) AS candidate, l_returnflag, avg(l_quantity) AS r2
  FROM lineitem GROUP BY ALL),
means AS (SELECT candidate, avg(r2) AS mean_r2 FROM scores GROUP BY candidate)
SELECT candidate, round(mean_r2, 6) AS mean_r2 FROM means
ORDER BY mean_r2 DESC, candidate LIMIT 1
""")
def best_parameters(spark, sf_dir):
    scores = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_linenumber").cast("int").alias("candidate"), "l_returnflag").agg(
        F.avg("l_quantity").alias("r2"))
    return best_candidate(scores).select("candidate", rounded("mean_r2"))
