"""Token-id files in byte planes.

A file holds the ids of whole documents in order. The ids are cut into blocks of a fixed number;
each block is transposed into four byte planes (all lowest bytes, all second bytes, ...), and each
plane is compressed by itself with zstandard: the upper planes of small ids shrink to almost nothing.
An index at the end gives every block's place and planes, and every document's place.

    "BPL1" | planes of all blocks | index | index length (u32) | "BPL1"
    index (little-endian): ids per block u32, blocks u32, documents u32, ids u64,
        then the blocks' four plane lengths (u32 each), the documents' lengths in ids (u64 each)

Files are written by Spark as rows (file, content) of a Parquet table, so that they live wherever
Spark can write. A document never crosses files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked
from filing_jobs.llm.tokens import encoder

MAGIC = b"BPL1"
HEAD = "<IIIQ"
#: Ids in a block, and about how many in a file.
BLOCK, FILE = 65_536, 1 << 20


def file_bytes(documents: list[bytes], block: int = BLOCK, level: int = 3) -> bytes:
    """The file of these documents (each: ids as little-endian unsigned 32-bit integers)."""
    ids = np.frombuffer(b"".join(documents), "u1").reshape(-1, 4)
    press, planes, sizes = zstandard.ZstdCompressor(level=level), [], []
    for at in range(0, len(ids), block):
        for k in range(4):
            plane = press.compress(np.ascontiguousarray(ids[at : at + block, k]).tobytes())
            planes.append(plane)
            sizes.append(len(plane))
    index = pack(HEAD, block, len(sizes) // 4, len(documents), len(ids)) + np.array(sizes, "<u4").tobytes() + np.array([len(d) // 4 for d in documents], "<u8").tobytes()
    return b"".join([MAGIC, *planes, index, pack("<I", len(index)), MAGIC])


class TokenFile:
    """Reads a file: ``lengths`` of its documents, ``ids(start, stop)`` of any range, touching only the blocks it meets."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC or content[-4:] != MAGIC:
            raise ValueError("not a token file")
        (size,) = unpack_from("<I", content, len(content) - 8)
        at = len(content) - 8 - size
        self.block, blocks, documents, self.n = unpack_from(HEAD, content, at)
        sizes = np.frombuffer(content, "<u4", 4 * blocks, at + 20)
        self.lengths = np.frombuffer(content, "<u8", documents, at + 20 + 16 * blocks).astype("i8")
        self.places = 4 + np.concatenate([[0], np.cumsum(sizes, dtype="i8")])
        self.content = content

    def one(self, block: int) -> np.ndarray:
        n = min(self.block, self.n - block * self.block)
        out, zstd = np.empty((n, 4), "u1"), zstandard.ZstdDecompressor()
        for k in range(4):
            a, b = self.places[4 * block + k : 4 * block + k + 2]
            out[:, k] = np.frombuffer(zstd.decompress(self.content[a:b], max_output_size=n), "u1")
        return out.reshape(-1).view("<u4")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, "<u4")
        first = start // self.block
        found = np.concatenate([self.one(b) for b in range(first, (stop - 1) // self.block + 1)])
        return found[start - first * self.block : stop - first * self.block]


def files(df: DataFrame, tokenizer_path: str, *, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
          file_ids: int = FILE) -> DataFrame:
    """Rows (part, file, docs array<id>, ids long, content binary) in ascending order of the id.

    Each document's ids are those of its whole text (null: empty) and ``end_id``. The order is made by
    a range partitioning on the id and, for rows of one id, a hash of the text, so that many of them are
    spread too; null ids come first, a null text is the end id alone. A file holds whole documents:
    it ends with the document that takes it beyond ``file_ids``. No rows, no files.
    """
    end = end_id.to_bytes(4, "little")
    rows = picked(df, id=id_col, t=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        names: list = []
        documents: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            docs = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(names, key))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), docs, pa.array([held], pa.int64()), pa.array([file_bytes(documents, block)], pa.binary())], ["part", "file", "docs", "ids", "content"])

        for batch in batches:
            key = batch["id"].type
            for name, tokens in zip(batch["id"].to_pylist(), own.encode_all(batch["t"].to_pylist()), strict=True):
                tokens += end
                names.append(name)
                documents.append(tokens)
                held += len(tokens) // 4
                if held >= file_ids:
                    yield out()
                    names, documents, held, number = [], [], 0, number + 1
        if names:
            yield out()

    spread = rows.withColumn("spread", F.xxhash64("t"))
    ordered = spread.repartitionByRange("id", "spread").sortWithinPartitions("id", "spread", "t").select("id", "t")
    return ordered.mapInArrow(run, f"part int, file int, docs array<{kind}>, ids long, content binary")


def read_documents(table: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the stored files.

    ``start`` counts the ids of all documents before it over all files. Only the files' sizes are added
    up: within a part by a window, over the parts by a sum whose rows are as many as the writing tasks.
    """
    sizes = table.select("part", "file", "ids")
    before = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("ids"))
    earlier = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    base = sizes.withColumn("within", before).join(earlier, "part").select("part", "file", (F.col("base") + F.col("within")).alias("base"))
    kind = table.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = TokenFile(batch["content"][row].as_py())
                ids = own.ids().tobytes()
                ends = np.cumsum(own.lengths)
                starts = ends - own.lengths
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                same = pa.array(np.full(len(ends), row), pa.int64())
                yield pa.RecordBatch.from_arrays([batch["docs"][row].values, batch["part"].take(same), batch["file"].take(same), pa.array(starts, pa.int64()), pa.array(own.lengths, pa.int64()), pa.array(crc, pa.int64())], ["id", "part", "file", "at", "n_tokens", "ids_crc32"])

    found = table.select("part", "file", "docs", "content").mapInArrow(run, f"id {kind}, part int, file int, at long, n_tokens long, ids_crc32 long")
    return found.join(base, ["part", "file"]).select(F.col("id").alias(id_col), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
