"""A corpus pipeline: identify the language, keep one of each group of near copies, pseudonymise, pack.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and is written
as Parquet and read again before the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_jobs.llm import jaccard, langid, packing, pii
from filing_jobs.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return langid.keep_identified(docs.select(COLUMNS))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    return jaccard.keep_first(docs.select(COLUMNS))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes pseudonyms; n_chars is that of the new text."""
    return pii.pseudonyms(docs.select(COLUMNS), key=pii.session_key(spark)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths; the ids as little-endian unsigned 32-bit integers."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", join_near_copies),
    ("personal data", replace_personal_data),
    ("packing", pack_tokens),
]

#: SQL expresses none of the models and ciphers; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``. Null and letterless texts go in the first stage, exact repeats in the second; no rows, no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
