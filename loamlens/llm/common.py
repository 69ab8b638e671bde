"""What several operators share: reading, row keys, the labelled split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space, the only separator of words unless an operator says otherwise
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the documents no model may learn labels from; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))


def text_key(text: str | Column = "text") -> Column:
    """A digest that is equal for equal texts; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(column, F.lit("")))


def text_digest(text: str = "text") -> tuple[Column, Column]:
    """128 bits, ``h1`` and ``h2``, that tell different texts apart."""
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), F.col(text)).alias("h2")


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one column ``row``, so that no name of the input can clash with a helper's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row`` again, those in ``changed`` with a new value."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])
