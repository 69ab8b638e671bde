"""Group-aware splits of the events by user."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamlens.operators.split import assign_folds, group_holdout, shared_groups, with_folds
from loamlens.queries.inputs import folds_sql, holdout_sql
from loamlens.queries.registry import query, table


@query(f"""
WITH {holdout_sql('events', 'user_id')}
SELECT event_id, e.user_id, is_holdout FROM events e JOIN held h ON e.user_id = h.user_id
""")
def group_shuffle_split(spark, sf_dir):
    return group_holdout(table(spark, sf_dir, "events"), "user_id").select(
        "event_id", "user_id", "is_holdout")


@query(f"""
WITH {holdout_sql('events', 'user_id')}
SELECT count(*) FILTER (WHERE NOT is_holdout) AS n_train_groups,
       count(*) FILTER (WHERE is_holdout) AS n_holdout_groups, 0::BIGINT AS n_shared_groups
FROM held
""")
def split_disjoint(spark, sf_dir):
    events = group_holdout(table(spark, sf_dir, "events"), "user_id")
    train, held = events.where(~F.col("is_holdout")), events.where("is_holdout")
    shared = shared_groups(train, held, "user_id").withColumn("shared", F.lit(True))
    sides = events.select("user_id", "is_holdout").distinct().join(shared, "user_id", "left")
    return sides.agg(
        F.count_if(~F.col("is_holdout")).alias("n_train_groups"),
        F.count_if("is_holdout").alias("n_holdout_groups"),
        F.count_if(F.coalesce("shared", F.lit(False))).alias("n_shared_groups"))


@query(f"""
WITH RECURSIVE {folds_sql('events', 'user_id', 'BIGINT')}
SELECT user_id, group_rows, fold FROM folds
""")
def group_kfold(spark, sf_dir):
    return assign_folds(table(spark, sf_dir, "events"), "user_id")


@query(f"""
WITH RECURSIVE {folds_sql('events', 'user_id', 'BIGINT')}
SELECT f.fold, count(DISTINCT e.user_id) AS n_groups, count(*) AS n_rows
FROM events e JOIN folds f ON e.user_id = f.user_id GROUP BY f.fold
""")
def fold_sizes(spark, sf_dir):
    return with_folds(table(spark, sf_dir, "events"), "user_id").groupBy("fold").agg(
        F.count_distinct("user_id").alias("n_groups"), F.count(F.lit(1)).alias("n_rows"))
