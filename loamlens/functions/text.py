"""Cleaning expressions for dirty numbers, text and missing values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a category that cannot occur in data, standing for "missing".
MISSING_CATEGORY = "␀"


def parse_dirty_number(text: Column) -> Column:
    """Keep digits and dots only and read the rest as a number; unreadable text is null.

    Signs, thousands separators, exponents and footnote letters are lost, so ``-5`` reads as 5
    and ``1e3`` as 13.
    """
    return F.regexp_replace(text.cast("string"), "[^0-9.]", "").try_cast("double")


def parse_year(year: Column) -> Column:
    """Whole calendar year, or null. ``1999.0`` is accepted, ``1999.5`` is not."""
    number = F.trim(year.cast("string")).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def normalise_text(text: Column) -> Column:
    """Upper case without any leading or trailing white space (``trim`` strips blanks only)."""
    return F.upper(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def nan_to_null(value: Column) -> Column:
    """NaN compares greater than every number in Spark; missing values must be null here."""
    return F.when(~F.isnan(value), value)


def category_or_missing(category: Column) -> Column:
    """Category as a comparable string in which all missing values are one category."""
    return F.coalesce(category.cast("string"), F.lit(MISSING_CATEGORY))
