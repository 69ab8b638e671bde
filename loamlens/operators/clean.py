"""Cleaning of raw yield records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from loamlens.functions.text import nan_to_null, normalise_text, parse_dirty_number, parse_year
from loamlens.schemas import YIELD_HIGH, YIELD_LOW


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Missing numbers become null in every floating point column."""
    floating = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floating}) if floating else df


def parse_crops(crops: DataFrame) -> DataFrame:
    """Parsed value and year, normalised names; no row is dropped yet."""
    return crops.withColumns({
        "yield_value": parse_dirty_number(F.col("value")),
        "year": parse_year(F.col("year")),
        "state_name": normalise_text(F.col("state_name")),
        "county_name": normalise_text(F.col("county_name")),
    }).drop("value")


def valid_crops(parsed: DataFrame, low: float = YIELD_LOW, high: float = YIELD_HIGH) -> DataFrame:
    """Rows with a year, a state and a yield strictly between the bounds."""
    return parsed.where(
        F.col("year").isNotNull() & F.col("state_name").isNotNull()
        & (F.col("yield_value") > low) & (F.col("yield_value") < high)
    )


def clean_crops(crops: DataFrame, low: float = YIELD_LOW, high: float = YIELD_HIGH) -> DataFrame:
    return valid_crops(parse_crops(crops), low, high)


def crop_quality(parsed: DataFrame, low: float = YIELD_LOW, high: float = YIELD_HIGH) -> DataFrame:
    """One row of counts: what is read, what is dropped at each step, how many states remain."""
    year, value, state = F.col("year"), F.col("yield_value"), F.col("state_name")
    in_range = F.coalesce((value > low) & (value < high), F.lit(False))
    usable = year.isNotNull() & in_range
    return parsed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(year.isNull()).alias("n_invalid_year"),
        F.count_if(year.isNotNull() & ~in_range).alias("n_out_of_range"),
        F.count_if(usable & state.isNull()).alias("n_missing_state"),
        F.count_if(usable & state.isNotNull()).alias("n_valid"),
        F.count_distinct(F.when(usable, state)).alias("n_states"),
    )
