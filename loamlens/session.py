"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("loamlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder intermediate tables are written to.

    It is the one named by ``spark.checkpoint.dir``, which every executor can reach. Only a local
    session, where driver and executors share one disk, makes a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loamlens-"))
    return context.getCheckpointDir()


#: session setting that names the folder of a job's intermediate tables
TABLES = "loamlens.tables"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[str]:
    """What ``durable`` stores within the block is in one folder, which is deleted at its end.

    Frames that still read such tables are of no use afterwards.
    """
    outer = spark.conf.get(TABLES, None)
    folder = f"{(outer or checkpoint_dir(spark)).rstrip('/')}/loamlens-job-{uuid4().hex}"
    spark.conf.set(TABLES, folder)
    try:
        yield folder
    finally:
        if outer is None:
            spark.conf.unset(TABLES)
        else:
            spark.conf.set(TABLES, outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from a table in the checkpoint folder.

    What follows does not depend on any executor's memory or disk, reads only the columns it
    needs, and is planned with the table's real size.
    """
    spark = df.sparkSession
    folder = spark.conf.get(TABLES, None) or checkpoint_dir(spark)
    path = f"{folder.rstrip('/')}/loamlens-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
