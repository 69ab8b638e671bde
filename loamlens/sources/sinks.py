"""Outputs of the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Write and read back: what follows starts from the files, not from the lineage."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path).select(*df.columns)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with a header, without any index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.option("header", True).schema(like.schema).csv(path)
