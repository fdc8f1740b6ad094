"""Token ids of whole texts by a file of the tokenizers library, through a memo of independent pieces.

Both pre-tokenizers used here match their pattern from left to right and never over the pieces cut
below, so a text's ids are its pieces' ids one after the other. Each distinct piece goes to the
library once per Python worker (until the memo is full), which is most of the saving. Texts are taken
many at a time, so that all new pieces among them go to the library in one call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice
from struct import pack

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has one worker for each core

#: White space as the library's patterns have it (``\s`` there lacks U+001C to U+001F).
SPACE = "\t-\r \x85\xa0  -     　"
#: Letters of which a run is one match of ``\p{L}+`` if an ASCII character that is no letter, a space or the end follows.
LATIN, FOLLOWS = "A-Za-zÀ-ÖØ-öø-ɏ", rf"(?![^{SPACE}!-@\[-`{{-~])"
#: A byte-level pattern keeps one blank in front of a word; of other white space the last character stands alone.
BYTE_PIECES = re.compile(rf" ?[{LATIN}]+{FOLLOWS}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: A pattern that drops white space. Without U+0130: its lower case ends in a mark, which would join what follows the run.
WORD_PIECES = re.compile(rf"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+{FOLLOWS}|[^{SPACE}]+")
#: Only characters for which lower case is the same letter by letter and NFC changes nothing.
PLAIN = re.compile("[^\x00-įı-ɏ]")
#: Words that the normalizer leaves alone if they are in lower case; each is one match of ``\p{L}+``.
LOWER_WORD = re.compile("[a-zß-öø-įı-ɏ]+")
#: New words that go to the library as one text.
JOINED = 1000
#: Pieces kept in a worker's memo, how many of them stay when it is full, and pieces looked up at a time.
MEMO, STAY, AT_ONCE = 600_000, 200_000, 250_000
#: Longer pieces are not kept.
LONGEST = 64


class PieceEncoder:
    """``encode(text)``: all ids as little-endian unsigned 32-bit integers, as the library with ``add_special_tokens=False``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.drops_space = self.library.normalizer is not None
        self.pieces = WORD_PIECES if self.drops_space else BYTE_PIECES
        self.memo: dict[str, bytes] = {}
        self.ends = None
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        if self.drops_space and suffix:  # then a word's last id is known by itself
            vocab = self.library.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.bare = Tokenizer(self.library.model)
            self.bare.pre_tokenizer = self.library.pre_tokenizer

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text. Null counts as empty. A text that holds the string of a special token goes to the library as a whole."""
        out: list[list[bytes]] = []
        held: list[tuple[list[bytes], list[str]]] = []
        size = 0
        for text in texts:
            own: list[bytes] = []
            out.append(own)
            if not text:
                continue
            if any(s in text for s in self.special):
                own.append(self.whole(text))
                continue
            for pieces in self.cut(text):
                held.append((own, pieces))
                size += len(pieces)
                if size >= AT_ONCE:
                    self.look_up(held)
                    held, size = [], 0
        self.look_up(held)
        return [b"".join(own) for own in out]

    def cut(self, text: str) -> Iterator[list[str]]:
        """The text's pieces, so many at a time: a very long text is never in pieces as a whole."""
        if self.drops_space and not PLAIN.search(text):
            text = text.lower()
        if len(text) <= AT_ONCE:
            yield self.pieces.findall(text)
            return
        found = map(re.Match.group, self.pieces.finditer(text))
        while part := list(islice(found, AT_ONCE)):
            yield part

    def look_up(self, held: list[tuple[list[bytes], list[str]]]) -> None:
        """Put the ids of each list of pieces behind those of its text."""
        memo = self.memo
        found = [list(map(memo.get, pieces)) for _, pieces in held]
        new = list({p for (_, pieces), ids in zip(held, found, strict=True) if None in ids for p, x in zip(pieces, ids, strict=True) if x is None})
        known = self.words([p for p in new if LOWER_WORD.fullmatch(p) and p == p.lower()]) if self.ends is not None else {}
        new = [p for p in new if p not in known]
        known |= zip(new, (pack(f"<{len(x)}I", *x) for x in (e.ids for e in self.library.encode_batch_fast(new, add_special_tokens=False))), strict=True)
        for (own, pieces), ids in zip(held, found, strict=True):
            own.append(b"".join([known[p] if x is None else x for p, x in zip(pieces, ids, strict=True)] if None in ids else ids))
        if len(memo) + len(known) > MEMO:  # those that came first are the most frequent ones
            self.memo = memo = dict(islice(memo.items(), STAY))
        memo.update((p, x) for p, x in known.items() if len(p) < LONGEST)

    def words(self, new: list[str]) -> dict[str, bytes]:
        """The ids of plain words in lower case. Many go to the library as one text without its normalizer, and are cut behind each word's last id."""
        groups = [new[i : i + JOINED] for i in range(0, len(new), JOINED)]
        known: dict[str, bytes] = {}
        for group, found in zip(groups, self.bare.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            cuts, raw = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), ids.tobytes()
            known |= zip(group, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts)), strict=True)
        return known


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
