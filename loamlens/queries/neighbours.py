"""Mixed distances and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.functions.distance import GOWER, SMOOTH
from loamlens.operators.neighbors import (
    cv_similarity as similarity_by_fold, local_variance as variance_of_neighbours,
    mean_nn_similarity, mixed_space, nn_similarity_per_row)
from loamlens.operators.split import group_holdout
from loamlens.queries.inputs import (
    CUSTOMER_CATEGORICAL, CUSTOMER_NUMERIC, CUSTOMER_SQL, PART_CATEGORICAL, PART_NUMERIC, PART_SQL,
    customer_features, holdout_sql, local_variance_sql, part_features)
from loamlens.queries.registry import query, rounded


def gower_sql(a: str, b: str, width: str) -> str:
    """Gower distance of the customers ``a`` and ``b``; the constant column has no range."""
    return f"""
  (coalesce(abs({a}.balance - {b}.balance) / {width}.balance_w, 0)
   + coalesce(abs({a}.n_orders - {b}.n_orders) / {width}.n_orders_w, 0)
   + CASE WHEN {a}.segment <> {b}.segment THEN 1 ELSE 0 END)
  / nullif((CASE WHEN {a}.balance IS NOT NULL AND {b}.balance IS NOT NULL THEN 1 ELSE 0 END)
           + (CASE WHEN {a}.n_orders IS NOT NULL AND {b}.n_orders IS NOT NULL THEN 1 ELSE 0 END)
           + (CASE WHEN {a}.segment IS NOT NULL AND {b}.segment IS NOT NULL THEN 1 ELSE 0 END),
           0)::DOUBLE"""


WIDTHS = """SELECT max(balance) - min(balance) AS balance_w, max(n_orders) - min(n_orders) AS n_orders_w"""


def _successors(spark, sf_dir, policy):
    """Distance of every customer to the one with the next number."""
    customers = customer_features(spark, sf_dir)
    space = mixed_space(customers, CUSTOMER_NUMERIC, CUSTOMER_CATEGORICAL, policy)
    a, b = customers.alias("a"), customers.alias("b")
    return a.join(b, F.col("a.row_id") + 1 == F.col("b.row_id")).select(
        F.col("a.row_id").alias("row_id"), rounded(space.between("a", "b"), "distance"))


@query(f"""
WITH {CUSTOMER_SQL}, w AS ({WIDTHS} FROM customers)
SELECT a.row_id, round(coalesce({gower_sql('a', 'b', 'w')}, 0), 6) AS distance
FROM customers a JOIN customers b ON a.row_id + 1 = b.row_id CROSS JOIN w
""")
def gower_distance(spark, sf_dir):
    return _successors(spark, sf_dir, GOWER)


@query(f"""
WITH {CUSTOMER_SQL}, w AS ({WIDTHS} FROM customers)
SELECT a.row_id,
       round(0.75::DOUBLE * (coalesce(abs(a.balance - b.balance) / balance_w, 0)
              + coalesce(abs(a.n_orders - b.n_orders) / n_orders_w, 0))
             / ((CASE WHEN a.balance IS NOT NULL AND b.balance IS NOT NULL THEN 1 ELSE 0 END)
                + (CASE WHEN a.n_orders IS NOT NULL AND b.n_orders IS NOT NULL THEN 1 ELSE 0 END)
                + 1)
             + 0.25::DOUBLE * (CASE WHEN coalesce(a.segment, '-') <> coalesce(b.segment, '-')
                                    THEN 1 ELSE 0 END), 6) AS distance
FROM customers a JOIN customers b ON a.row_id + 1 = b.row_id CROSS JOIN w
""")
def mixed_distance(spark, sf_dir):
    return _successors(spark, sf_dir, SMOOTH)


def _train_and_test(spark, sf_dir):
    customers = group_holdout(customer_features(spark, sf_dir), "row_id")
    return customers.where(~F.col("is_holdout")), customers.where("is_holdout")


NN_SQL = f"""
{CUSTOMER_SQL},
{holdout_sql('customers', 'row_id')},
train AS (SELECT c.* FROM customers c JOIN held h ON c.row_id = h.row_id WHERE NOT is_holdout),
test AS (SELECT c.* FROM customers c JOIN held h ON c.row_id = h.row_id WHERE is_holdout),
w AS ({WIDTHS} FROM train),
best AS (
  SELECT a.row_id, any_value(a.balance) AS balance, any_value(a.n_orders) AS n_orders,
         any_value(a.segment) AS segment,
         1 - min(round(coalesce({gower_sql('a', 'b', 'w')}, 0), 12)) AS similarity
  FROM test a CROSS JOIN train b CROSS JOIN w GROUP BY a.row_id
)"""


@query(f"""
WITH {NN_SQL}
SELECT min(row_id) AS vid, count(*) AS weight, round(any_value(similarity), 6) AS similarity
FROM best GROUP BY balance, n_orders, segment
""")
def gower_nn_rows(spark, sf_dir):
    train, test = _train_and_test(spark, sf_dir)
    closest = nn_similarity_per_row(train, test, CUSTOMER_NUMERIC, CUSTOMER_CATEGORICAL)
    return closest.select("vid", "weight", rounded("similarity"))


@query(f"""
WITH {NN_SQL}
SELECT round(avg(similarity), 6) AS mean_test_to_train_similarity FROM best
""")
def gower_nn(spark, sf_dir):
    train, test = _train_and_test(spark, sf_dir)
    return mean_nn_similarity(train, test, CUSTOMER_NUMERIC, CUSTOMER_CATEGORICAL).select(
        rounded("mean_test_to_train_similarity"))


@query(f"""
WITH {CUSTOMER_SQL},
w AS (SELECT v.fold, max(balance) - min(balance) AS balance_w,
             max(n_orders) - min(n_orders) AS n_orders_w
      FROM (SELECT DISTINCT fold FROM customers) v JOIN customers c ON c.fold <> v.fold
      GROUP BY v.fold),
best AS (
  SELECT a.row_id, a.fold, 1 - min(round(coalesce({gower_sql('a', 'b', 'w')}, 0), 12)) AS similarity
  FROM customers a JOIN customers b ON a.fold <> b.fold JOIN w ON w.fold = a.fold
  GROUP BY a.row_id, a.fold
)
SELECT CAST(fold AS INTEGER) AS fold, round(avg(similarity), 6) AS mean_test_to_train_similarity
FROM best GROUP BY fold
""")
def cv_similarity(spark, sf_dir):
    result = similarity_by_fold(customer_features(spark, sf_dir), CUSTOMER_NUMERIC,
                                CUSTOMER_CATEGORICAL, range(5))
    return result.select("fold", rounded("mean_test_to_train_similarity"))


@query(f"""
WITH {PART_SQL}, {local_variance_sql('parts')}
SELECT row_id, round(local_var, 6) AS local_var FROM local
""")
def local_variance(spark, sf_dir):
    result = variance_of_neighbours(part_features(spark, sf_dir), "y", PART_NUMERIC,
                                    PART_CATEGORICAL)
    return result.select("row_id", rounded("local_var"))
