"""ISO base media containers: writing 8-bit sample tracks and reading tables without the payload.

The reader walks nested boxes, decodes the sample tables of each track and gives codec, duration and
the byte ranges of keyframes; it never looks into ``mdat``. The writer stores bytes losslessly as
unsigned 8-bit mono audio: one sample per byte, chunks of a fixed number of samples.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from filing_jobs.llm.common import picked

#: Boxes that only hold other boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
RATE, CHUNK, PAD = 8000, 65_536, 64
#: Levels of boxes that are walked; real files have about ten.
DEEPEST = 32
#: Bytes of a box's body that its fixed fields take.
FIXED = {b"hdlr": 12, b"stsd": 16, b"stsz": 12, b"stts": 8, b"stsc": 8, b"stco": 8, b"co64": 8, b"stss": 8}
MATRIX = pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return pack(">I", len(body) + 8) + kind + body
    return pack(">I", 1) + kind + pack(">Q", len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, pack(">I", version << 24 | flags), *parts)


def padded(data: bytes, to: int = PAD) -> bytes:
    """Bytes 0 up to a positive multiple of ``to``."""
    return data + bytes(max(to, -(-len(data) // to) * to) - len(data))


def write_media(payload: bytes, rate: int = RATE, chunk: int = CHUNK) -> bytes:
    """A container whose one audio track has the payload as unsigned 8-bit samples (codec ``raw ``)."""
    n = len(payload)
    whole, rest = divmod(n, chunk)
    chunks = whole + bool(rest)
    runs = ([(1, chunk)] if whole else []) + ([(whole + 1, rest)] if rest else [])
    head = box(b"ftyp", b"isom", pack(">I", 0x200), b"isomiso2")

    def moov(base: int) -> bytes:
        entry = box(b"raw ", bytes(6), pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, rate << 16))
        table = box(
            b"stbl",
            full(b"stsd", pack(">I", 1), entry),
            full(b"stts", pack(">III", 1, n, 1)),
            full(b"stsc", pack(">I", len(runs)), *(pack(">III", first, size, 1) for first, size in runs)),
            full(b"stsz", pack(">II", 1, n)),
            full(b"co64", pack(">I", chunks), (base + np.arange(chunks, dtype=">u8") * chunk).astype(">u8").tobytes()),
        )
        information = box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", pack(">I", 1), full(b"url ", flags=1))), table)
        media = box(b"mdia", full(b"mdhd", pack(">QQIQHH", 0, 0, rate, n, 0x55C4, 0), version=1), full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0"), information)
        track = box(b"trak", full(b"tkhd", pack(">QQIIQ", 0, 0, 1, 0, n), bytes(8), pack(">hhHH", 0, 0, 0x100, 0), MATRIX, bytes(8), version=1, flags=7), media)
        return box(b"moov", full(b"mvhd", pack(">QQIQ", 0, 0, rate, n), pack(">IH", 0x10000, 0x100), bytes(10), MATRIX, bytes(24), pack(">I", 2), version=1), track)

    start = len(head) + len(moov(0)) + (8 if n + 8 < 1 << 32 else 16)
    return head + moov(start) + box(b"mdat", payload)


def boxes(data: bytes, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, body start, body end) of every box, parents before children.

    A broken size ends the box it is in; boxes below DEEPEST levels are not walked.
    """
    open_ = [(start, len(data) if end is None else end, path)]
    while open_:
        start, end, path = open_.pop()
        if start + 8 > end:
            continue
        size, kind = unpack_from(">I4s", data, start)
        head = 8
        if size == 1 and start + 16 <= end:
            (size,), head = unpack_from(">Q", data, start + 8), 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            continue
        own = (*path, kind)
        yield own, start + head, start + size
        open_.append((start + size, end, path))
        if kind in CONTAINERS and len(own) < DEEPEST:
            open_.append((start + head, start + size, own))


@dataclass
class Track:
    """A track's tables as arrays: sample sizes, durations, byte offsets, and which samples are keyframes."""

    handler: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    samples: int = 0
    fixed_size: int = 0
    times: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), "i8"))
    runs: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), "i8"))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, "i8"))
    chunks: np.ndarray = field(default_factory=lambda: np.zeros(0, "i8"))
    sync: np.ndarray | None = None

    def per_chunk(self) -> np.ndarray:
        """Samples of each chunk: a run of the table holds up to the next run's first chunk."""
        counts = np.zeros(len(self.chunks), "i8")
        if not len(self.runs):
            return counts
        # chunks count from 1; a broken table may go beyond them or backwards
        first = np.maximum.accumulate(np.clip(self.runs[:, 0], 1, len(self.chunks) + 1) - 1)
        counts[first[0] :] = np.repeat(self.runs[:, 1], np.diff(first, append=len(self.chunks)))
        return counts

    def ranges(self) -> np.ndarray:
        """Byte ranges (offset, size) of the chunks; samples in a chunk lie one after the other."""
        counts = self.per_chunk()
        upto = np.cumsum(counts)
        return np.stack([self.chunks, self.bytes_before(upto) - self.bytes_before(upto - counts)], axis=1)

    def bytes_before(self, sample: np.ndarray) -> np.ndarray:
        """How many bytes the samples before each one have together; there are no more than the table has."""
        sample = np.minimum(sample, self.samples)
        if self.fixed_size:
            return sample * self.fixed_size
        return np.concatenate([[0], np.cumsum(self.sizes)])[np.minimum(sample, len(self.sizes))]

    def keyframes(self) -> np.ndarray:
        """Byte ranges of keyframes. Without a sync table every sample is one; those of a chunk are given as one range."""
        if self.sync is None:
            return self.ranges()
        counts = self.per_chunk()
        first = np.cumsum(counts) - counts
        sample = self.sync[(self.sync > 0) & (self.sync <= min(self.samples, counts.sum()))] - 1
        if not len(sample):
            return np.zeros((0, 2), "i8")
        of = np.searchsorted(first, sample, side="right") - 1
        before = self.bytes_before(sample)
        return np.stack([self.chunks[of] + before - self.bytes_before(first[of]), self.bytes_before(sample + 1) - before], axis=1)


def read_media(data: bytes) -> list[Track]:
    """All tracks of a container. Bytes that are no container give no tracks.

    A box too short for its fields is passed over, a table that says it is longer than its box is empty, and
    offsets beyond 2^62 count as 2^62. Time and memory follow the length of ``data``, whatever its numbers say.
    """
    tracks: list[Track] = []
    for path, a, b in boxes(data):
        kind = path[-1]
        if kind == b"trak":
            tracks.append(Track())
        if not tracks or b"trak" not in path:
            continue
        own = tracks[-1]
        if b - a < FIXED.get(kind, 0):
            continue
        if kind == b"mdhd":
            if b - a >= 20 and data[a] != 1:
                own.timescale, own.duration = unpack_from(">II", data, a + 12)
            elif b - a >= 32:
                own.timescale, own.duration = unpack_from(">IQ", data, a + 20)
        elif kind == b"hdlr":
            own.handler = data[a + 8 : a + 12].decode("latin-1")
        elif kind == b"stsd":
            own.codec = data[a + 12 : a + 16].decode("latin-1").strip()
        elif kind == b"stsz":
            own.fixed_size, own.samples = unpack_from(">II", data, a + 4)
            own.sizes = _table(data, a + 12, b, ">u4", 0 if own.fixed_size else own.samples)
            own.samples = min(own.samples, (1 << 61) // own.fixed_size) if own.fixed_size else len(own.sizes)
        elif kind in (b"stts", b"stsc", b"stco", b"co64", b"stss"):
            (n,) = unpack_from(">I", data, a + 4)
            if kind == b"stts":
                own.times = _table(data, a + 8, b, ">u4", 2 * n).reshape(-1, 2)
            elif kind == b"stsc":
                own.runs = _table(data, a + 8, b, ">u4", 3 * n).reshape(-1, 3)
            elif kind == b"stss":
                own.sync = _table(data, a + 8, b, ">u4", n)
            else:
                own.chunks = _table(data, a + 8, b, ">u8" if kind == b"co64" else ">u4", n)
    return tracks


def _table(data: bytes, start: int, end: int, kind: str, n: int) -> np.ndarray:
    room = max(0, end - start) // np.dtype(kind).itemsize
    return np.minimum(np.frombuffer(data, kind, n, start).astype("u8"), np.uint64(1 << 62)).astype("i8") if n and n <= room else np.zeros(0, "i8")


def payload_of(data: bytes, track: Track) -> bytes:
    """The track's bytes, chunk by chunk; no more than the file has, should broken chunks overlap."""
    parts, left = [], len(data)
    for a, n in track.ranges().tolist():
        parts.append(data[a : a + min(n, left)])
        left -= len(parts[-1])
        if not left:
            break
    return b"".join(parts)


def feature_of(tracks: list[Track]) -> str:
    """Codec, seconds, number of samples, and the number, first and last byte range of the keyframes, of each track."""
    out = []
    for t in tracks:
        frames = t.keyframes().tolist()
        seconds = t.duration / t.timescale if t.timescale else 0
        ends = f" [{frames[0][0]},{frames[0][1]}]..[{frames[-1][0]},{frames[-1][1]}]" if frames else ""
        out.append(f"{t.handler}/{t.codec} {seconds:.6f}s {t.samples} samples {len(frames)} keyframe ranges{ends}")
    return "; ".join(out)


#: Every track's codec, seconds and samples, and the byte ranges of all its keyframes.
TRACKS = pa.list_(pa.struct([("handler", pa.string()), ("codec", pa.string()), ("duration", pa.float64()), ("samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64())])))]))
TRACKS_DDL = "array<struct<handler:string,codec:string,duration:double,samples:bigint,keyframes:array<struct<offset:bigint,size:bigint>>>>"


def columns_of(tracks: list[Track]) -> list[dict]:
    """The tracks as TRACKS."""
    return [
        {"handler": t.handler, "codec": t.codec, "duration": t.duration / t.timescale if t.timescale else 0.0, "samples": t.samples, "keyframes": [{"offset": a, "size": n} for a, n in t.keyframes().tolist()]}
        for t in tracks
    ]


def to_media(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes long, media binary): every whole text (null: empty) as UTF-8, padded, in a container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # small batches: a container is as long as its text
                batch = whole.slice(at, 256)
                texts = [(t or "").encode() for t in batch["t"].to_pylist()]
                media = pa.array([write_media(padded(x)) for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(list(map(len, texts)), pa.int64()), media], ["id", "n_bytes", "media"])

    rows = picked(df, id=id_col, t=text_col)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def features(df: DataFrame, *, id_col: str = "doc_id", media_col: str = "media", tail: int = PAD, carry: tuple[str, ...] = ()) -> DataFrame:
    """What the stored bytes say: payload size, sha256 and tail crc32, the container's size and sha256, the feature,
    and of every track the codec, duration and all keyframe byte ranges.

    Null and broken containers give a payload of 0 bytes, an empty feature and no tracks. ``carry``: columns of
    ``df`` to keep. Equal bytes give equal values.
    """
    carried = {f"carried_{k}": name for k, name in enumerate(carry)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for data in batch["m"].to_pylist():
                data = data or b""
                tracks = read_media(data)
                payload = payload_of(data, tracks[0]) if tracks else b""
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-tail:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(tracks), columns_of(tracks)))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), TRACKS]
            yield pa.RecordBatch.from_arrays([batch["id"], *(batch[c] for c in carried), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", *carried, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tracks"])

    rows = picked(df, id=id_col, m=media_col, **carried)
    kept = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"id {rows.schema['id'].dataType.simpleString()}{kept}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tracks {TRACKS_DDL}"
    return rows.mapInArrow(run, schema).withColumnsRenamed({"id": id_col} | carried)
