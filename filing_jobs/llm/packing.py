"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the binary digits of n, none longer than
the window; each piece is a sequence of its own. Sequences of one length form a bucket, so nothing is
padded and no sequence crosses documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked
from filing_jobs.llm.tokens import encoder

PIECES = "id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: sequence_id: the bucket's exponent (5 bits), the task's partition (26 bits), the running number in the task (32 bits).
PARTITION_BITS, NUMBER_BITS = 26, 32


def lengths(n: int, window: int) -> list[int]:
    """Windows as long as they fit, then the binary digits of the rest from the greatest on."""
    rest = n % window
    return [window] * (n // window) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(df: DataFrame, tokenizer_path: str, *, end_id: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Each document's ids are those of its whole text and ``end_id``; null and empty texts give that one
    token; repeated rows each have their pieces; texts are whole however long. ``window`` is a power of two. ``offset`` is always 0. Sequence ids sort by bucket; they are
    unique, and a task's retry gives the same ones for the same input partition. Nothing is shuffled.
    Without ``with_ids`` the column ``ids_crc32`` (unsigned) stands in place of ``ids``.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, partition, number = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        if partition >> PARTITION_BITS:
            raise ValueError("too many partitions for sequence ids")
        for batch in batches:
            which, start, length, ids, total, sequence = [], [], [], [], [], []
            for k, tokens in enumerate(own.encode_all(batch["t"].to_pylist())):
                tokens += end
                n, at = len(tokens) // 4, 0
                for size in lengths(n, window):
                    piece = tokens[4 * at : 4 * (at + size)]
                    which.append(k)
                    start.append(at)
                    length.append(size)
                    ids.append(piece if with_ids else zlib.crc32(piece))
                    total.append(n)
                    sequence.append((size.bit_length() - 1) << (PARTITION_BITS + NUMBER_BITS) | partition << NUMBER_BITS | number)
                    at += size
                    number += 1
            zero = pa.array([0] * len(which), pa.int64())
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(which, pa.int64())), long(start), long(length), pa.array(ids, pa.binary() if with_ids else pa.int64()), long(total), long(sequence), zero], ["id", "start", "length", "ids" if with_ids else "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    rows = picked(df, id=id_col, t=text_col)
    schema = PIECES.format(kind=rows.schema["id"].dataType.simpleString())
    return rows.mapInArrow(run, schema if with_ids else schema.replace("ids binary", "ids_crc32 long")).withColumnRenamed("id", id_col)


def buckets(pieces: DataFrame) -> DataFrame:
    """(length, sequences, tokens): the size of each bucket of equally long sequences."""
    return pieces.groupBy("length").agg(F.count("*").alias("sequences"), F.sum("length").alias("tokens"))
