"""Shared helpers of the training-data operators: intermediate tables, splits and safe columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_jobs.store import new_folder
from filing_jobs.store import stored as stored

#: ASCII white space, as the word definition ``[^\x20\x09-\x0D]+`` excludes it. ``bytes.split()`` splits at exactly these.
ASCII_SPACE = "\x20\x09-\x0d"


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % F.lit(n)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns under the operator's own names, so that other columns can't clash with them."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


@contextmanager
def while_stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` for the time of a block: its files go at the end, so nothing may be read from it later."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bounding_count(counted: DataFrame, most: int) -> int:
    """The least count that at most ``most`` rows of (.., c) reach; 1 if all may stay."""
    top = 1 << 16
    sizes = {r["c"]: r["n"] for r in counted.groupBy(F.least(F.col("c"), F.lit(top)).alias("c")).agg(F.count("*").alias("n")).collect()}
    if sizes.get(top, 0) > most:
        total = counted.agg(F.sum("c")).first()[0]
        return max(top, -(-total // most)) if most else total + 1
    reached, least = 0, top
    for c in sorted(sizes, reverse=True):
        reached += sizes[c]
        if reached > most:
            break
        least = c
    return least if reached > most else 1
