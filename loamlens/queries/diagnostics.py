"""Fold statistics, high-variance shares and their correlation, on the parts by brand."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.operators.metrics import (
    bad_fold_summary, correlation, fold_stats, high_variance_by_fold, instability,
    variance_threshold)
from loamlens.operators.neighbors import local_variance
from loamlens.operators.skew import salted_join
from loamlens.operators.split import group_holdout, with_folds
from loamlens.queries.inputs import (
    PART_CATEGORICAL, PART_NUMERIC, PART_SQL, folds_sql, holdout_sql, local_variance_sql,
    part_features)
from loamlens.queries.registry import query, rounded
from loamlens.session import durable


def predicted_parts(spark, sf_dir):
    """Parts in folds by brand, each predicted by the mean of its type in the other folds."""
    parts = durable(with_folds(part_features(spark, sf_dir), "p_brand"))
    by_fold = parts.groupBy("p_type", "fold").agg(
        F.sum("y").alias("s"), F.count(F.lit(1)).alias("n"))
    total = by_fold.groupBy("p_type").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    other = by_fold.join(total, "p_type").select(
        "p_type", "fold", ((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n")))
        .alias("prediction"))
    # one row per type and fold
    return parts.join(other, ["p_type", "fold"])


PREDICTED_SQL = f"""
{PART_SQL},
{folds_sql('parts', 'p_brand', 'VARCHAR')},
in_fold AS (SELECT p.*, f.fold FROM parts p JOIN folds f ON p.p_brand = f.p_brand),
sums AS (SELECT p_type, fold, sum(y) AS s, count(*) AS n FROM in_fold GROUP BY p_type, fold),
totals AS (SELECT p_type, sum(s) AS ts, sum(n) AS tn FROM sums GROUP BY p_type),
predicted AS (
  SELECT i.*, (t.ts - s.s) / (t.tn - s.n) AS prediction
  FROM in_fold i JOIN sums s ON i.p_type = s.p_type AND i.fold = s.fold
  JOIN totals t ON i.p_type = t.p_type
),
fold_scores AS (
  SELECT fold, sqrt(avg((y - prediction) ** 2)) AS rmse, avg(abs(y - prediction)) AS mae,
         1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*)) AS r2,
         var_samp(y) / (SELECT var_samp(y) FROM parts) AS y_var_norm, max(y) - min(y) AS y_range
  FROM predicted GROUP BY fold
)"""

HIGH_SQL = f"""
{local_variance_sql('parts')},
threshold AS (SELECT quantile_cont(local_var, 0.9) AS t FROM local),
fold_shares AS (
  SELECT fold, avg(CASE WHEN coalesce(local_var > t, FALSE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
           AS high_var_frac
  FROM in_fold i JOIN local l ON i.row_id = l.row_id CROSS JOIN threshold GROUP BY fold
)"""


@query(f"""
WITH RECURSIVE {PREDICTED_SQL}
SELECT fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2,
       round(y_var_norm, 6) AS y_var_norm, round(y_range, 6) AS y_range, r2 < 0.3 AS is_bad_fold
FROM fold_scores
""")
def fold_metrics(spark, sf_dir):
    stats = fold_stats(predicted_parts(spark, sf_dir), "y", "prediction")
    return stats.select("fold", *[rounded(c) for c in ("rmse", "mae", "r2", "y_var_norm",
                                                       "y_range")], "is_bad_fold")


@query(f"""
WITH RECURSIVE {PREDICTED_SQL}
SELECT bool_or(r2 < 0.3) AS any_bad_fold, count(*) FILTER (WHERE r2 < 0.3) AS n_bad_folds,
       coalesce(string_agg(CAST(fold AS VARCHAR), ',' ORDER BY fold) FILTER (WHERE r2 < 0.3), '')
         AS bad_folds
FROM fold_scores
""")
def bad_folds(spark, sf_dir):
    summary = bad_fold_summary(fold_stats(predicted_parts(spark, sf_dir), "y", "prediction"))
    return summary.withColumn(
        "bad_folds", F.array_join(F.col("bad_folds").cast("array<string>"), ","))


def _variances(parts):
    return durable(local_variance(parts, "y", PART_NUMERIC, PART_CATEGORICAL))


def _shares(parts):
    variances = _variances(parts)
    in_fold = salted_join(parts.select("row_id", "fold"), variances, ["row_id"])
    return high_variance_by_fold(in_fold, variance_threshold(variances))


@query(f"""
WITH RECURSIVE {PREDICTED_SQL}, {HIGH_SQL}
SELECT fold, round(high_var_frac, 6) AS high_var_frac FROM fold_shares
""")
def high_variance_folds(spark, sf_dir):
    parts = durable(with_folds(part_features(spark, sf_dir), "p_brand"))
    return _shares(parts).select("fold", rounded("high_var_frac"))


@query(f"""
WITH RECURSIVE {PREDICTED_SQL}, {HIGH_SQL}
SELECT round(corr(r2, high_var_frac), 6) AS r2_high_var_corr
FROM fold_scores s JOIN fold_shares h ON s.fold = h.fold
""")
def stability_correlation(spark, sf_dir):
    parts = predicted_parts(spark, sf_dir)
    folds = fold_stats(parts, "y", "prediction").join(_shares(parts), "fold")
    return folds.agg(rounded(correlation("r2", "high_var_frac"), "r2_high_var_corr"))


@query(f"""
WITH {PART_SQL}, {local_variance_sql('parts')},
threshold AS (SELECT quantile_cont(local_var, 0.9) AS t FROM local)
SELECT round(any_value(t), 6) AS threshold,
       round(avg(local_var) / (SELECT var_samp(y) FROM parts), 6) AS local_var_normalised,
       round(avg(CASE WHEN coalesce(local_var > t, FALSE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS high_var_frac
FROM local CROSS JOIN threshold
""")
def local_variance_summary(spark, sf_dir):
    parts = part_features(spark, sf_dir)
    variances = _variances(parts)
    threshold = variance_threshold(variances)
    target_var = parts.agg(F.var_samp("y").alias("v")).first()["v"]
    return instability(variances, target_var, threshold).select(
        rounded(F.lit(threshold), "threshold"), rounded("local_var_normalised"),
        rounded("high_var_frac"))


@query(f"""
WITH {PART_SQL},
{holdout_sql('parts', 'p_brand')},
train AS (SELECT p.* FROM parts p JOIN held h ON p.p_brand = h.p_brand WHERE NOT is_holdout),
holdout AS (SELECT p.* FROM parts p JOIN held h ON p.p_brand = h.p_brand WHERE is_holdout),
{local_variance_sql('holdout', 'held_local')},
threshold AS (SELECT quantile_cont(local_var, 0.9) AS t FROM held_local)
SELECT round(avg(local_var) / (SELECT var_samp(y) FROM train), 6) AS local_var_normalised,
       round(avg(CASE WHEN coalesce(local_var > t, FALSE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS high_var_frac
FROM held_local CROSS JOIN threshold
""")
def holdout_instability(spark, sf_dir):
    parts = group_holdout(part_features(spark, sf_dir), "p_brand")
    train, holdout = parts.where(~F.col("is_holdout")), parts.where("is_holdout")
    variances = _variances(holdout)
    train_var = train.agg(F.var_samp("y").alias("v")).first()["v"]
    return instability(variances, train_var, variance_threshold(variances)).select(
        rounded("local_var_normalised"), rounded("high_var_frac"))
