"""SentencePiece BPE encoding with a prefix table.

Under merge-type BPE every prefix of a text has exactly one encoding, so it has one last token. The
table holds that token for each prefix: an automaton lists the pieces that end at a position, and the
one that is compatible with the last token of the prefix before it is the entry. The ids then follow
by walking back from the end. The work is linear in the text, whatever the order of its merges.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from filing_jobs.llm.common import picked

SPACE = "▁"
#: Chunks kept in a task's memo; it only saves time.
MEMO = 700_000
NEVER = 1 << 60
#: Latin letters; most vocabularies join none of them with other characters.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


class PrefixTableEncoder:
    """Encoder and decoder for one BPE model file; equal to the library's own, without sampling."""

    def __init__(self, model_path: str):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ids = {sp.id_to_piece(i): i for i in usable}
        score = {i: sp.get_score(i) for i in usable}
        self.piece = {i: p for p, i in ids.items()}
        # single characters come before any merge; characters without a piece of their own get a pseudo token
        for c in sorted({c for p in ids for c in p} - ids.keys()):
            ids[c] = -1 - ord(c)
            self.piece[ids[c]] = c
        self.ids = ids
        merged = sorted((i for p, i in ids.items() if len(p) > 1), key=lambda i: -score[i])
        self.rank = {i: 0 for p, i in ids.items() if len(p) == 1} | {i: k for k, i in enumerate(merged, 1)}
        self.parts: dict[int, tuple[int, int]] = {}
        automaton = ahocorasick.Automaton()
        for p, i in ids.items():
            if len(p) == 1 or self._last_merge(p, i):
                automaton.add_word(p, (len(p), i))
        automaton.make_automaton()
        self.automaton = automaton
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.ends = np.array([sp.bos_id()], "<u4").tobytes(), np.array([sp.eos_id()], "<u4").tobytes()
        self.cut = self._boundaries()

    def _last_merge(self, piece: str, whole: int) -> bool:
        """Find the two tokens whose merge makes the piece; false if merging by rank never makes it."""
        tokens, last = [self.ids[c] for c in piece], None
        while len(tokens) > 1:
            pairs = [(self.rank[c], k) for k in range(len(tokens) - 1) if (c := self.ids.get(self.piece[tokens[k]] + self.piece[tokens[k + 1]])) is not None]
            if not pairs:
                return False
            _, k = min(pairs)
            last = tokens[k], tokens[k + 1]
            tokens[k : k + 2] = [self.ids[self.piece[last[0]] + self.piece[last[1]]]]
        self.parts[whole] = last
        return True

    def _boundaries(self) -> re.Pattern:
        """Where a text may be cut without changing its encoding: between characters that stand beside each other in no piece."""
        beside = {(p[k], p[k + 1]) for p in self.ids if len(p) > 1 for k in range(len(p) - 1)}
        if any(b == SPACE != a for a, b in beside):
            return re.compile(r"[\s\S]+")
        latin = re.compile(f"[{LATIN}]")
        if any(SPACE != a and bool(latin.match(a)) != bool(latin.match(b)) for a, b in beside):
            return re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(rf"{SPACE}*[{LATIN}]+|{SPACE}*[^{SPACE}{LATIN}]+|{SPACE}+")

    def compatible(self, left: int, right: int) -> bool:
        """Whether both tokens stay as they are side by side.

        Undo their merges from the latest on, along the seam. A merge over the seam wins if it comes
        before the merges that took its two parts further; of equal ones the leftmost comes first.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, a_until, b_until, result = left, right, NEVER, NEVER, True
        while a is not None and b is not None:
            over = self.ids.get(self.piece[a] + self.piece[b])
            if over is not None and self.rank[over] < a_until and self.rank[over] <= b_until:
                result = False
                break
            if self.rank[a] > self.rank[b] or (self.rank[a] == self.rank[b] and a in self.parts):
                a_until, a = self.rank[a], self.parts[a][1]
            elif b in self.parts:
                b_until, b = self.rank[b], self.parts[b][0]
            else:
                break
        if len(self.fits) < 4 * MEMO:
            self.fits[left, right] = result
        return result

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of a normalised text by the prefix table; characters outside the vocabulary become byte ids."""
        n = len(text)
        last: list[int | None] = [None] * (n + 1)  # None: an unknown character, over which nothing merges
        length = [1] * (n + 1)
        fits, compatible = self.fits, self.compatible
        for at, (size, token) in self.automaton.iter(text):
            end = at + 1
            if last[end] is None:
                before = last[end - size]
                if before is None or ((known := fits.get((before, token))) is None and compatible(before, token)) or known:
                    last[end], length[end] = token, size
        out, at = [], n
        while at:
            token = last[at]
            if token is None or token < 0:
                out.extend(self.bytes[x] for x in reversed(text[at - 1].encode()))
                at -= 1
            else:
                out.append(token)
                at -= length[at]
        return out[::-1]

    def encode(self, text: str | None) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers; null counts as empty."""
        memo, parts = self.memo, [self.ends[0]]
        for chunk in self.cut.findall(self.model.normalize(text)) if text else ():
            if (found := memo.get(chunk)) is None:
                ids = self.encode_chunk(chunk)
                found = pack(f"<{len(ids)}I", *ids)
                if len(memo) < MEMO and len(chunk) < 64:
                    memo[chunk] = found
            parts.append(found)
        parts.append(self.ends[1])
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


#: One encoder for each model file and Python worker: building it takes about a second.
_encoders: dict[str, PrefixTableEncoder] = {}


def encoder(model_path: str) -> PrefixTableEncoder:
    if model_path not in _encoders:
        _encoders[model_path] = PrefixTableEncoder(model_path)
    return _encoders[model_path]


def encode(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row; null and empty texts give begin and end only.

    ``model_path`` must be readable on every executor (a file of the installed tokenizer package).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path)
        for batch in batches:
            ids = [own.encode(t) for t in batch["t"].to_pylist()]
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").view("<i4"))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype("i4"))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.ListArray.from_arrays(offsets, flat), pa.array([own.decode(x) for x in ids], pa.string())], ["id", "ids", "decoded"])

    rows = picked(df, id=id_col, t=text_col)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): as ``encode``, with digests in place of the ids and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path)
        for batch in batches:
            ids = [own.encode(t) for t in batch["t"].to_pylist()]
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            of_ids = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
            of_text = pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch["id"], n, of_ids, of_text], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = picked(df, id=id_col, t=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
