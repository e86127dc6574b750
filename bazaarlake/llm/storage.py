"""Tables and folders that all executors share, for results that a later step reads."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below spark.checkpoint.dir, else below the context's checkpoint folder, else in the warehouse.

    The folder is removed when the driver's JVM ends.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    folder = f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


# Narrow rows that one task writes, where their number is known.
ROWS_PER_TASK = 200_000
# Rows that Python tasks are given at once where they hold whole texts or sets, of which the JVM and Python hold copies.
WIDE_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write_table(df: DataFrame, purpose: str, rows: int | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write a DataFrame to a shared folder and read it back: its lineage ends there.

    With an upper bound of its rows, short tables are written by few tasks. ``batch_rows`` bounds the batches of its Python tasks, if
    the session does not hold them smaller.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, purpose)
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))
    before = spark.conf.get(BATCH_SETTING)
    if batch_rows is not None and not 0 < int(before) < batch_rows:
        spark.conf.set(BATCH_SETTING, batch_rows)
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return spark.read.schema(df.schema).parquet(folder)


def drop_table(df: DataFrame) -> None:
    """Remove a table made by write_table that nothing reads any more."""
    spark = df.sparkSession
    for name in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)
