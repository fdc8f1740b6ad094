"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is unset (a local session) a new temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``new_folder`` before the session ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage and survives lost executors.

    With ``by``, its last column, one folder for each value of it. The folder goes when the session's JVM ends.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    written = df.write.option("compression", "zstd")
    (written.partitionBy(by) if by else written).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
