"""Dirty numbers, text, years, missing values and derived features on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from loamlens.errors import EmptyInputError
from loamlens.functions.derive import add_derived_features
from loamlens.functions.text import (
    category_or_missing, nan_to_null, normalise_text, parse_dirty_number, parse_year)
from loamlens.operators.clean import clean_crops, nulls_for_nan
from loamlens.sources.readers import crop_scan, read_table, require_rows
from loamlens.sources.sinks import read_csv, write_csv, write_table
from loamlens.schemas import CROP_SCHEMA


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_dirty_numbers(spark):
    values = ["1,234.5", "(D)", "-5", "1.2.3", "1e3", ".", "", None, "5.", ".5", "99 (H)", "0"]
    expected = [1234.5, None, 5.0, None, 13.0, None, None, None, 5.0, 0.5, 99.0, 0.0]
    assert column(spark, values, "string", parse_dirty_number) == expected


def test_years(spark):
    values = ["1999", " 2001 ", "1999.0", "1999.5", "n/a", "", None]
    assert column(spark, values, "string", parse_year) == [1999, 2001, 1999, None, None, None, None]


def test_text_is_stripped_of_all_white_space(spark):
    assert column(spark, ["\tIowa\n", "   ", " new york ", None], "string", normalise_text) \
        == ["IOWA", "", "NEW YORK", None]


def test_nan_is_missing(spark):
    assert column(spark, [float("nan"), 1.0, None], "double", nan_to_null) == [None, 1.0, None]
    df = spark.createDataFrame([(float("nan"), 1)], "a double, b int")
    assert nulls_for_nan(df).first()[:] == (None, 1)


def test_missing_category_is_one_category(spark):
    values = column(spark, ["a", None, None], "string", category_or_missing)
    assert values[0] == "a" and values[1] == values[2] is not None


def crops(spark, *rows):
    return spark.createDataFrame(rows, CROP_SCHEMA)


def test_crop_scan_and_cleaning(spark):
    raw = crops(
        spark,
        ("CORN", "YIELD", "1990", "120.5", " iowa", "x ", "BU"),
        ("CORN", "YIELD", "1990", "1,000", "iowa", "x", "BU"),      # not below 1000
        ("CORN", "YIELD", "1990", "0", "iowa", "x", "BU"),          # not above 0
        ("CORN", "YIELD", "1990", "(D)", "iowa", "x", "BU"),        # no number
        ("CORN", "YIELD", "1990", "-5", "Ohio", None, "BU"),        # the sign is lost
        ("CORN", "YIELD", "1990", "50", None, "x", "BU"),           # no state
        ("CORN", "AREA", "1990", "50", "iowa", "x", "BU"),
        ("RICE", "YIELD", "1990", "50", "iowa", "x", "BU"),
        ("CORN", "YIELD", "1947", "50", "iowa", "x", "BU"),
        ("CORN", "YIELD", "never", "50", "iowa", "x", "BU"),
    )
    kept = clean_crops(crop_scan(raw)).select("state_name", "year", "yield_value").collect()
    assert sorted(map(tuple, kept)) == [("IOWA", 1990, 120.5), ("OHIO", 1990, 5.0)]


def test_empty_input_is_named(spark):
    with pytest.raises(EmptyInputError, match="nass"):
        require_rows(crops(spark), "nass")


def soil(spark, **values):
    names = ["ph_h2o", "cec_nh4_ph_7", "clay_total", "avg_temperature", "ca_nh4_ph_7",
             "mg_nh4_ph_7", "growing_degree_days", "commodity_desc"]
    schema = ", ".join(f"{n} {'string' if n == 'commodity_desc' else 'double'}" for n in names)
    row = tuple(values.get(n) for n in names)
    return add_derived_features(spark.createDataFrame([row], schema)).first()


@pytest.mark.parametrize("t, expected", [(22.0, 1.0), (0.0, 0.0), (50.0, 0.0), (33.0, 0.5),
                                         (None, None)])
def test_temp_optimality(spark, t, expected):
    assert soil(spark, avg_temperature=t)["temp_optimality"] == expected


@pytest.mark.parametrize("ca, mg, expected", [(6.0, 2.0, 3.0), (6.0, 0.0, 5.0), (6.0, None, 5.0),
                                              (None, 2.0, None), (None, 0.0, 5.0)])
def test_ca_mg_ratio(spark, ca, mg, expected):
    assert soil(spark, ca_nh4_ph_7=ca, mg_nh4_ph_7=mg)["ca_mg_ratio"] == expected


@pytest.mark.parametrize("cec, expected", [(10.0, 36.0), (None, None)])
def test_soil_quality(spark, cec, expected):
    row = soil(spark, ph_h2o=6.0, cec_nh4_ph_7=cec, clay_total=20.0)
    assert row["soil_quality_score"] == expected


@pytest.mark.parametrize("crop, gdd, expected", [
    ("CORN", 1000.0, "Optimal"), ("CORN", 2000.0, "Optimal"), ("CORN", 999.9, "Suboptimal"),
    ("CORN", None, "Suboptimal"), ("corn", 1500.0, "Suboptimal"), ("RICE", 1500.0, "Suboptimal"),
    (None, 1500.0, "Optimal"), ("BARLEY", 1300.0, "Optimal"), ("COTTON", 1300.0, "Suboptimal"),
])
def test_gdd_suitability(spark, crop, gdd, expected):
    assert soil(spark, commodity_desc=crop, growing_degree_days=gdd)["gdd_suitability"] == expected


def test_absent_commodity_defaults(spark):
    df = spark.range(1).selectExpr(
        "1D ph_h2o", "1D cec_nh4_ph_7", "1D clay_total", "1D avg_temperature", "1D ca_nh4_ph_7",
        "1D mg_nh4_ph_7", "1500D growing_degree_days")
    assert add_derived_features(df).first()["commodity_desc"] == "CORN"


def test_sinks_and_sources(spark, tmp_path):
    df = crops(spark, ("CORN", "YIELD", "1990", "1,5", "iowa", "x", "BU"),
               ("WHEAT", "YIELD", None, "2", "ohio", None, "BU"))
    stored = write_table(df, f"{tmp_path}/t", partition_by="state_name")
    assert sorted(stored.collect()) == sorted(df.collect())
    write_csv(df, f"{tmp_path}/c")
    assert sorted(map(str, read_csv(spark, f"{tmp_path}/c", df).collect())) \
        == sorted(map(str, df.collect()))
    assert sorted(map(str, read_table(spark, f"{tmp_path}/c", CROP_SCHEMA, "csv").collect())) \
        == sorted(map(str, df.collect()))


def test_declared_types_are_cast_and_other_columns_kept(spark, tmp_path):
    """A year stored as a number stays one if it may, and its range reaches the files."""
    stored = spark.createDataFrame(
        [("CORN", "YIELD", 1990, "2", "ohio", None, "BU", 7),
         ("CORN", "YIELD", 1890, "2", "ohio", None, "BU", 8),
         ("CORN", "YIELD", None, "2", "ohio", None, "BU", 9)],
        "commodity_desc string, statisticcat_desc string, year int, value string, "
        "state_name string, county_name string, unit_desc string, extra int")
    stored.write.parquet(f"{tmp_path}/y")
    cast = read_table(spark, f"{tmp_path}/y", CROP_SCHEMA)
    assert cast.columns == [*CROP_SCHEMA.names, "extra"]
    assert sorted(str(r.year) for r in cast.collect()) == ["1890", "1990", "None"]
    for df in (cast, read_table(spark, f"{tmp_path}/y", CROP_SCHEMA, as_is=("year",))):
        assert [str(r.year) for r in crop_scan(df).collect()] == ["1990"]
    plan = crop_scan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(" not in plan and ">= 1948" in plan
