"""Scaling and one-hot encoding, fitted on one part of the parts and applied to all."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loamlens.operators.encode import MIN_MAX, NumericScaler, feature_encoder, one_hot_stages
from loamlens.queries.registry import query, rounded, table

TYPES_SEEN = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("price"), F.lit(3.0).alias("constant"),
        F.when(F.col("p_size") > 1, F.col("p_type")).alias("kind"), "p_type")


@query("""
WITH fitted AS (SELECT * FROM part WHERE p_type <> 'PROMO'),
stats AS (SELECT avg(p_size) AS size_mean, stddev_pop(p_size) AS size_std,
                 avg(p_retailprice) AS price_mean, stddev_pop(p_retailprice) AS price_std
          FROM fitted)
SELECT p_partkey, round((p_size - size_mean) / size_std, 6) + 0.0 AS size,
       round((p_retailprice - price_mean) / price_std, 6) + 0.0 AS price,
       0.0::DOUBLE AS constant
FROM part CROSS JOIN stats
""")
def scale_standard(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = NumericScaler(["size", "price", "constant"]).fit(rows.where("p_type <> 'PROMO'"))
    return model.transform(rows).select("p_partkey", rounded("size"), rounded("price"),
                                        rounded("constant"))


@query("""
WITH stats AS (SELECT min(p_size) AS s, max(p_size) - min(p_size) AS sw,
                      min(p_retailprice) AS p, max(p_retailprice) - min(p_retailprice) AS pw
               FROM part)
SELECT p_partkey, round((p_size - s) / sw::DOUBLE, 6) AS size,
       round((p_retailprice - p) / pw, 6) AS price, 0.0::DOUBLE AS constant
FROM part CROSS JOIN stats
""")
def scale_minmax(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = NumericScaler(["size", "price", "constant"], MIN_MAX).fit(rows)
    return model.transform(rows).select("p_partkey", rounded("size"), rounded("price"),
                                        rounded("constant"))


@query("SELECT p_partkey, " + ", ".join(
    f"CASE WHEN p_size > 1 AND p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{t.lower()}"
    for t in TYPES_SEEN) + " FROM part")
def one_hot(spark, sf_dir):
    rows = parts(spark, sf_dir)
    fit_on = rows.where("p_type <> 'PROMO' AND kind IS NOT NULL")
    model = Pipeline(stages=one_hot_stages(["kind"])).fit(fit_on)
    slots = vector_to_array("kind_onehot")
    return model.transform(rows).select(
        "p_partkey", *[slots[i].alias(f"is_{t.lower()}") for i, t in enumerate(TYPES_SEEN)])


@query("""
WITH stats AS (SELECT avg(p_size) AS m, stddev_pop(p_size) AS s FROM part WHERE p_type <> 'PROMO')
SELECT p_partkey, round((p_size - m) / s, 6) + 0.0 AS f0, """ + ", ".join(
    f"CASE WHEN p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f{i + 1}"
    for i, t in enumerate(TYPES_SEEN)) + " FROM part CROSS JOIN stats")
def encoded_features(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = feature_encoder(["size"], ["p_type"]).fit(rows.where("p_type <> 'PROMO'"))
    vector = vector_to_array("features")
    return model.transform(rows).select(
        "p_partkey", *[rounded(vector[i], f"f{i}") for i in range(1 + len(TYPES_SEEN))])
