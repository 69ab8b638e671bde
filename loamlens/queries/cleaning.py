"""Scans, cleaning and scalar expressions."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F, types as T

from loamlens.functions.derive import add_derived_features
from loamlens.functions.text import category_or_missing, normalise_text, parse_year
from loamlens.operators.clean import clean_crops, crop_quality, parse_crops
from loamlens.operators.order_stats import distinct_head
from loamlens.queries.inputs import (
    COMMODITY_SQL, CUSTOMER_SQL, PART_COMMODITIES, RECORD_KEY, SAMPLE_SQL, crop_records, crop_sql,
    customer_features, order_samples)
from loamlens.queries.registry import query, rounded, table
from loamlens.schemas import FeatureSpec
from loamlens.session import checkpoint_dir
from loamlens.sources.readers import crop_scan, read_table, require_rows
from loamlens.sources.sinks import read_csv, write_csv


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def full_scan(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/supplier.parquet")


@query("SELECT * REPLACE (CAST(p_size AS DOUBLE) AS p_size) FROM part")
def declared_scan(spark, sf_dir):
    """A declared type other than the stored one, and undeclared columns."""
    declared = T.StructType([T.StructField("p_partkey", T.LongType()),
                             T.StructField("p_size", T.DoubleType())])
    return read_table(spark, f"{sf_dir}/part.parquet", declared)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def checked_scan(spark, sf_dir):
    """Raises instead of going on without rows."""
    nations = read_table(spark, f"{sf_dir}/nation.parquet")
    return require_rows(nations, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_round_trip(spark, sf_dir):
    """Written as CSV with a header and read again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = f"{checkpoint_dir(spark).rstrip('/')}/loamlens-{uuid4().hex}"
    write_csv(orders, path)
    return read_csv(spark, path, orders)


@query("SELECT p_partkey, p_brand, p_size FROM part")
def column_subset_scan(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")


@query(f"""
WITH {crop_sql()}
SELECT commodity_desc, year, value, state_name, county_name, unit_desc
FROM crops
WHERE statisticcat_desc = 'YIELD' AND commodity_desc IN {COMMODITY_SQL}
  AND TRY_CAST(year AS DOUBLE) BETWEEN 1996 AND 1999
""")
def filtered_scan(spark, sf_dir):
    return crop_scan(crop_records(spark, sf_dir), "YIELD", PART_COMMODITIES, 1996, 1999)


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""")
def pushed_filter_scan(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp"))
        & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
    ).select("o_orderkey", "o_totalprice")


@query(f"""
WITH {crop_sql()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, yield_value,
       coalesce(yield_value > 0 AND yield_value < 1000, FALSE) AS kept
FROM parsed
""")
def clean_number(spark, sf_dir):
    value = F.col("yield_value")
    return parse_crops(crop_records(spark, sf_dir)).select(
        *RECORD_KEY, "yield_value",
        F.coalesce((value > 0) & (value < 1000), F.lit(False)).alias("kept"))


@query(f"""
WITH {crop_sql()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRY_CAST(year AS INTEGER) AS year
FROM crops WHERE TRY_CAST(year AS INTEGER) IS NOT NULL
""")
def year_coercion(spark, sf_dir):
    return (
        crop_records(spark, sf_dir).withColumn("year", parse_year(F.col("year")))
        .where(F.col("year").isNotNull()).select(*RECORD_KEY, "year")
    )


@query(f"""
WITH {crop_sql(unit=10)}
SELECT commodity_desc, statisticcat_desc, year, yield_value, state_name, county_name, unit_desc,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM parsed
WHERE year IS NOT NULL AND state_name IS NOT NULL AND yield_value > 0 AND yield_value < 1000
""")
def clean_records(spark, sf_dir):
    return clean_crops(crop_records(spark, sf_dir, unit=10))


@query(f"""
WITH {crop_sql(unit=10)}
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE year IS NULL) AS n_invalid_year,
       count(*) FILTER (WHERE year IS NOT NULL
                        AND NOT coalesce(yield_value > 0 AND yield_value < 1000, FALSE))
         AS n_out_of_range,
       count(*) FILTER (WHERE year IS NOT NULL AND yield_value > 0 AND yield_value < 1000
                        AND state_name IS NULL) AS n_missing_state,
       count(*) FILTER (WHERE year IS NOT NULL AND yield_value > 0 AND yield_value < 1000
                        AND state_name IS NOT NULL) AS n_valid,
       count(DISTINCT state_name) FILTER (WHERE year IS NOT NULL AND yield_value > 0
                                          AND yield_value < 1000) AS n_states
FROM parsed
""")
def cleaning_counts(spark, sf_dir):
    return crop_quality(parse_crops(crop_records(spark, sf_dir, unit=10)))


@query(r"""
SELECT n_nationkey, upper(regexp_replace(chr(9) || lower(n_name) || '  ' || chr(10), '^\s+|\s+$',
                                         '', 'g')) AS state_name
FROM nation
""")
def normalised_names(spark, sf_dir):
    untidy = F.concat(F.lit("\t"), F.lower("n_name"), F.lit("  \n"))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", normalise_text(untidy).alias("state_name"))


@query(f"""
WITH {crop_sql()}
SELECT DISTINCT state_name FROM parsed WHERE state_name IS NOT NULL ORDER BY state_name LIMIT 10
""")
def first_state_names(spark, sf_dir):
    return distinct_head(parse_crops(crop_records(spark, sf_dir)), "state_name", 10)


@query(f"""
WITH {SAMPLE_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE state_name IS NULL) AS n_missing,
       count(DISTINCT state_name) AS n_states
FROM samples
""")
def null_key_counts(spark, sf_dir):
    return order_samples(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("state_name").isNull()).alias("n_missing"),
        F.count_distinct("state_name").alias("n_states"))


@query(f"""
WITH {CUSTOMER_SQL}
SELECT row_id, balance, n_orders, segment FROM customers
""")
def feature_selection(spark, sf_dir):
    spec = FeatureSpec(numeric=("balance", "n_orders"), categorical=("segment",))
    return customer_features(spark, sf_dir).select("row_id", *spec.features)


@query(f"""
WITH {CUSTOMER_SQL}
SELECT coalesce(segment, '␀') AS segment, count(*) AS n FROM customers GROUP BY 1
""")
def category_as_text(spark, sf_dir):
    return (
        customer_features(spark, sf_dir)
        .groupBy(category_or_missing(F.col("segment")).alias("segment"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def soil_rows(spark, sf_dir):
    """Line items and their parts in the role of weather and soil measurements."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    lines = table(spark, sf_dir, "lineitem")
    measured = F.col("l_discount") != 0
    crop = (F.when(F.col("p_type") == "STANDARD", "CORN").when(F.col("p_type") == "MEDIUM", "SOYBEANS")
            .when(F.col("p_type") == "PROMO", "WHEAT").when(F.col("p_type") == "SMALL", "COTTON")
            .when(F.col("p_type") == "LARGE", "rice"))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
            *RECORD_KEY,
            (F.col("l_tax") * 100).alias("ph_h2o"),
            F.when(measured, F.col("l_quantity")).alias("cec_nh4_ph_7"),
            F.col("p_size").cast("double").alias("clay_total"),
            F.when(F.col("l_tax") != 0, F.col("l_quantity") - 10).alias("avg_temperature"),
            F.when(measured, F.col("p_size") / 2).alias("ca_nh4_ph_7"),
            F.when(F.col("l_tax") != 0, F.round(F.col("l_discount") * 100) - 2)
            .alias("mg_nh4_ph_7"),
            F.when(F.col("l_discount") != 0.1, F.floor(F.col("l_extendedprice") / 20)
                   .cast("double")).alias("growing_degree_days"),
            crop.alias("commodity_desc"))
    )


@query("""
WITH soil AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax * 100 AS ph,
         CASE WHEN l_discount <> 0 THEN l_quantity END AS cec, CAST(p_size AS DOUBLE) AS clay,
         CASE WHEN l_tax <> 0 THEN l_quantity - 10 END AS t,
         CASE WHEN l_discount <> 0 THEN p_size / 2 END AS ca,
         CASE WHEN l_tax <> 0 THEN round(l_discount * 100) - 2 END AS mg,
         CASE WHEN l_discount <> 0.1::DOUBLE THEN floor(l_extendedprice / 20) END AS gdd,
         coalesce(CASE p_type WHEN 'STANDARD' THEN 'CORN' WHEN 'MEDIUM' THEN 'SOYBEANS'
                              WHEN 'PROMO' THEN 'WHEAT' WHEN 'SMALL' THEN 'COTTON'
                              WHEN 'LARGE' THEN 'rice' END, 'CORN') AS commodity_desc
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, commodity_desc,
       round(ph + cec + clay, 6) AS soil_quality_score,
       CASE WHEN t IS NOT NULL THEN round(greatest(0, 1 - abs(t - 22) / 22), 6) END
         AS temp_optimality,
       round(CASE WHEN mg > 0 THEN ca / mg ELSE 5 END, 6) AS ca_mg_ratio,
       CASE WHEN (commodity_desc = 'CORN' AND gdd BETWEEN 1000 AND 2000)
              OR (commodity_desc = 'SOYBEANS' AND gdd BETWEEN 1200 AND 1800)
              OR (commodity_desc = 'WHEAT' AND gdd BETWEEN 800 AND 1400)
              OR (commodity_desc = 'COTTON' AND gdd BETWEEN 1400 AND 2000)
              OR (commodity_desc = 'BARLEY' AND gdd BETWEEN 900 AND 1300)
            THEN 'Optimal' ELSE 'Suboptimal' END AS gdd_suitability
FROM soil
""")
def derive_features(spark, sf_dir):
    return add_derived_features(soil_rows(spark, sf_dir)).select(
        *RECORD_KEY, "commodity_desc", rounded("soil_quality_score"), rounded("temp_optimality"),
        rounded("ca_mg_ratio"), "gdd_suitability")
