"""Filings that keep arriving: each micro-batch is shredded once and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filing_jobs.sources import shred

SOURCE = "path string, modificationTime timestamp, length long, content binary"


def arriving_filings(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """(path, content) of XML files as they arrive under ``root``."""
    stream = spark.readStream.format("binaryFile").schema(SOURCE).option("recursiveFileLookup", True).option("pathGlobFilter", "*.[xX][mM][lL]").option("maxFilesPerTrigger", max_files)
    return stream.load(root).select("path", "content")


def append_elements(filings: DataFrame, out: str, checkpoint: str, wanted: list[str] | None = None) -> StreamingQuery:
    """Header and element rows of new filings, appended below ``out``; stops when all there is has been read.

    Stateless: shredding looks at one filing at a time, so restarts continue at the checkpoint.
    """

    def write(batch: DataFrame, number: int) -> None:
        # a batch that is tried again writes the same folder, so nothing is there twice
        shred.headers(batch).write.mode("overwrite").parquet(f"{out}/headers/batch={number}")
        shred.shred_filings(batch, wanted).write.mode("overwrite").parquet(f"{out}/elements/batch={number}")

    return filings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def path_counts(elements: DataFrame) -> DataFrame:
    """(xpath, filings, elements) over all batches written so far."""
    return elements.groupBy("xpath").agg(F.count_distinct("path").alias("filings"), F.count("*").alias("elements"))
