"""One query for each operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from filing_jobs.llm import filters, isomedia, jaccard, langid, packing, phrases, pii, ppm, quotes, secrets, spbpe, tokenfile, topk
from filing_jobs.llm.common import stored
from filing_jobs.llm.oracles import oracle_sql as oracle_sql


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; nulls and texts without letters are ``und`` with score 0, repeated rows each have a row, no rows give none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every query; null, NaN and infinite components and null ids take no part, ties go to the smaller id, fewer candidates give fewer rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.search(vectors, F.col("vec_id") % 20 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document as digests; null counts as empty (begin and end alone), repeated rows each have a row, texts are whole however long."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spbpe.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms by the session's key; null stays null, texts without valid personal data stay as they are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pii.pseudonyms(docs.select("doc_id", "text"), key=pii.session_key(spark)).select("doc_id", "text", "pii_count", F.array_join("pii_kinds", ",").alias("pii_kinds"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; null counts as empty (the end alone), null ids learn as the empty id, repeated rows each count and have a row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ppm.score(docs, ppm.learning())


def op6_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of all built conversations; null text counts as empty, a message without a conversation stands alone, repeated rows stay."""
    chats = stored(quotes.chats(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "chats")
    found = chats.select("conv_id", "part", F.explode("messages").alias("m")).select("conv_id", "part", "m.*")
    return found.select("conv_id", "turn", "role", "content", F.col("n_quotes").cast("long").alias("n_quotes"), F.col("to_conv").alias("reply_conv"), F.col("to_turn").alias("reply_turn"), "by_quote", "part", "position")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the files; null text is the end id alone, null ids come first, repeated ids lie side by side."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = stored(tokenfile.files(docs, public_tokenizers.path("byte_bpe_50k.json")), "token-files")
    return tokenfile.read_documents(written)


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every stored container as read back; null text is 64 bytes 0, equal texts have equal values, repeated rows each have a row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = stored(isomedia.to_media(docs), "media")
    return isomedia.features(written, carry=("n_bytes",))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document; null and empty texts are the end id alone, repeated rows are packed each by itself, texts are whole however long."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component; null and empty texts link with nothing, repeated rows share a component, null ids name none."""
    return jaccard.join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases; null texts count as empty, null languages as ``und``, repeated rows each count, no words give no rows."""
    return phrases.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; null texts have none, repeated rows each have a row, texts are whole however long."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return secrets.digests(secrets.scan(docs, secrets.fit(docs)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders and steps of the five filters per language; null texts count as empty, null languages as the empty string, no rows give none."""
    return filters.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_exact_top_k": op2_exact_top_k,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_pii": op4_pii,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_chat_quotes": op6_chat_quotes,
        "op7_token_files": op7_token_files,
        "op8_media_columns": op8_media_columns,
        "op9_packing": op9_packing,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_secret_scan": op12_secret_scan,
        "op13_filter_audit": op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }
