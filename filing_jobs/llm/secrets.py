"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that finds what looks like their values elsewhere.

The field tags every token of a text as the begin of a secret, inside one, or outside: each character but white space lies
in a token, and a text is one chain. A token's scores are sums of weights that hang on it and on single neighbours, so
they are kept by token and added up for many texts at once. Where "outside" wins whatever the neighbours' tags are
(``surely_out``), a chain falls apart without changing its best path; what lies between is decoded by Viterbi.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked, stored

#: The kinds in their order; the last one is the field's.
KINDS = ("assign", "access", "hex", "tagged")
#: Fixed values. The patterns and the least length of a match (of its second group for the first one).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Texts without one of these (in small letters) have no match of the first pattern.
NAMES = ("passw", "secret", "token", "api")
#: The same as the first pattern, for Spark's own search.
ASSIGNED = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}"""
#: Words that look like secrets. The field learns from them apart, as they are the hardest to tell; it tags all tokens.
INNER = r"A-Za-z0-9+/_=.:~@%-"
WORD = re.compile(rf"(?<![{INNER}])(?=[{INNER}]{{8}})(?:[A-Za-z+/_=.:~@%-]*+[0-9][{INNER}]*+|[A-Za-z+/_=]{{20,}}+(?![{INNER}]))")
#: Tokens: runs of these characters, and runs of all others but white space.
TOKEN, TOKENS = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[A-Za-z0-9+/_-]+|[^A-Za-z0-9+/_\x20\x09-\x0D-]+")
CLASSES = np.array([0 if c in (0x20, *range(9, 14)) else 1 if TOKEN.match(chr(c)) else 2 for c in range(129)], np.int8)
SPACE = re.compile(r"[\x20\x09-\x0D]")
RUNS = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+")
OUT, BEGIN, INSIDE = 0, 1, 2
#: Weights of features are found by a hash of so many bits.
BITS = 16
#: Examples: tokens on each side of a secret, tokens at most, and tokens where no secret is.
ASIDE, LONGEST, PLAIN = 6, 64, 16
#: Characters after which a text is cut, characters scored together, and rows and characters of tokens kept.
STRETCH, TOGETHER, ROWS, KEYS = 1 << 20, 1 << 20, 200_000, 1 << 24
#: What a place's scores add up: its token after white space or joined to the one before; the tokens 1, 2, 3 before and 1
#: after; the characters before and after.
APART, JOINED, FIRST, SECOND, THIRD, NEXT, LEFT, RIGHT = range(8)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches; of each kind from the left, without overlaps."""
    found = []
    small = text.lower()
    if any(n in small for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def values(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where the secrets themselves are: an assignment's value, all of the others; what overlaps is one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ASSIGN.match(text, a).span(2) if kind == 0 else (a, b) for a, kind, b in spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def mixed_case(word: str) -> bool:
    return not word.islower() and not word.isupper() and word[1:] != word[1:].lower()


class Chain(NamedTuple):
    """The tokens of one word that looks like a secret."""

    spans: list[tuple[int, int]]


def hashed(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


named = lru_cache(1 << 14)(hashed)


class Look(NamedTuple):
    """What a token looks like: its classes of characters, how often they change, length, spread, and whether it is hexadecimal."""

    classes: str
    changes: int
    length: int
    spread: int
    hexed: bool


def look(token: str) -> Look:
    n, distinct = len(token), set(token)
    if token.isascii() and token.isalpha() and token.islower():
        classes, changes = "a", 0
    else:
        runs = RUNS.findall(token)
        classes = "".join(sorted({"a" if r[0].islower() else "A" if r[0].isupper() else "0" if r[0].isdigit() else "-" for r in runs}))
        changes = (len(runs) - 1) * 8 // n
    spread = log2(n)
    if len(distinct) < n:
        spread -= sum([c * log2(c) for c in map(token.count, distinct) if c > 1]) / n
    hexed = not token.strip("0123456789abcdef") or not token.strip("0123456789ABCDEF")
    return Look(classes, changes, min(n, 64) // 4, int(spread * 2), hexed)


def features_of_look(x: Look) -> list[int]:
    c, r, n, e, h = x
    return [*map(named, (f"c{c}", f"c{c}n{n}", f"n{n}", f"r{r}", f"r{r}c{c}", f"e{e}", f"e{e}n{n}", f"h{h}c{c}n{n}", "1"))]


def features_of_gap(joined: bool, classes: str) -> list[int]:
    return [named(f"g{joined:d}"), named(f"g{joined:d}{classes}")]


def begin(token: str) -> str:
    return token[:4] if not token[:4].isdigit() else "0"


def chains(text: str, source: str | None = None) -> Iterator[Chain]:
    """The words that look like secrets, wherever the text is from."""
    for m in WORD.finditer(text):
        if any(c.isdigit() for c in m[0]) or mixed_case(m[0]):
            spans = [t.span() for t in TOKEN.finditer(text, m.start(), m.end())]
            if spans:
                yield Chain(spans)


class Stretch(NamedTuple):
    """Tokens of a text in a row: with 3 tokens before and 1 after (empty where the text ends), which are joined to the one before, places."""

    tokens: list[str]
    joined: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    more: bool


def stretches(text: str) -> Iterator[Stretch]:
    """All tokens of a text. A long one comes in several stretches, cut where a token ends."""
    at, before = 0, ["", "", ""]
    if not text:
        yield Stretch([*before, ""], np.zeros(4, bool), np.zeros(0, int), np.zeros(0, int), False)
    while at < len(text):
        last = TOKENS.search(text, at + STRETCH)
        to = last.end() if last else len(text)
        part = text[at:to]
        classes = CLASSES[np.minimum(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]
        edges = np.concatenate([[0], np.flatnonzero(classes[1:] != classes[:-1]) + 1, [to - at]])
        held = np.flatnonzero(classes[edges[:-1]])
        starts, ends = edges[held], edges[held + 1]
        following = TOKENS.search(text, to)
        tokens = [*before, *TOKENS.findall(part), following[0] if following else ""]
        joined = np.zeros(len(tokens), bool)
        joined[4:-1] = starts[1:] == ends[:-1]
        if following:
            joined[-1] = following.start() == to and held[-1:].tolist() == [len(edges) - 2]
        if len(held):
            joined[3] = at > 0 and starts[0] == 0 and not SPACE.match(text, at - 1)
        yield Stretch(tokens, joined, starts + at, ends + at, following is not None)
        at, before = to, tokens[-4:-1]
        if not following:
            return


def marks(text: str, source: str | None) -> list[str]:
    """What all tokens of a text share."""
    return [f"f{source}", f"m{any(n in text for n in ('{', '};', '=>', '()'))}"]


def by_role(token: str) -> tuple[list[int], ...]:
    """The features that a token gives to itself and to its neighbours, in the order of the roles."""
    low = token.lower()
    w = hashed(f"w{low}")
    if token:
        x = look(token)
        own = [*features_of_look(x), named(f"b{begin(token)}")]
        apart, joined = (own + features_of_gap(g, x.classes) for g in (False, True))
    else:
        apart = joined = []
    return apart, joined, [hashed(f"p{low}"), w], [hashed(f"q{low}"), w], [w], [hashed(f"s{low[:12]}")], [named(f"l{token[-1:]}")], [named(f"a{token[:1]}")]


def features_of(tokens: list[str], joined: list[bool], shared: list[str]) -> tuple[list[list[int]], list[list[int]]]:
    """Features of each token between the 3 before and the 1 after: its own, and those of its neighbours and the text."""
    roles, text = [by_role(t) for t in tokens], [hashed(x) for x in shared]
    own = [roles[k][JOINED if joined[k] else APART] for k in range(3, len(tokens) - 1)]
    left = [roles[k - 1][LEFT] if joined[k] else [named("l ")] for k in range(3, len(tokens))]
    right = [roles[k + 1][RIGHT] if joined[k + 1] else [named("a ")] for k in range(3, len(tokens) - 1)]
    near = [[*roles[k - 1][FIRST], *roles[k - 2][SECOND], *roles[k - 3][THIRD], *roles[k + 1][NEXT], *left[k - 3], *right[k - 3], *text] for k in range(3, len(tokens) - 1)]
    return own, near


def tags_of(spans: Iterable[tuple[int, int]], secrets: list[tuple[int, int]]) -> list[int]:
    """The tags of tokens by known secrets (in order, apart): the first token of each is its begin."""
    out, within = [], -1
    for start, end in spans:
        k = bisect_right(secrets, (end - 1, 1 << 62)) - 1  # the last that begins before the token's end
        hit = k if k >= 0 and secrets[k][1] > start else -1
        out.append(OUT if hit < 0 else INSIDE if hit == within or not out and secrets[hit][0] < start else BEGIN)
        within = hit
    return out


class Model(NamedTuple):
    """Weights of features for each tag, and of a tag after a tag; before and after a chain stands OUT."""

    emission: np.ndarray
    transition: np.ndarray


def scores(model: Model, features: list[list[int]]) -> np.ndarray:
    return np.array([model.emission[f].sum(axis=0) for f in features])


def best_tags(model: Model, emitted: np.ndarray) -> list[int]:
    """Viterbi: the most probable tags of a chain; ties go to OUT, then BEGIN."""
    move, back = model.transition, []
    now = emitted[0] + move[OUT]
    for e in emitted[1:]:
        through = now[:, None] + move
        back.append(through.argmax(axis=0))
        now = through.max(axis=0) + e
    tag = int((now + move[:, OUT]).argmax())
    out = [tag]
    for step in reversed(back):
        tag = int(step[tag])
        out.append(tag)
    return out[::-1]


def total(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def expected(model: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward: the probability of each tag at each token, and the expected number of each change."""
    move, n = model.transition, len(emitted)
    ahead, behind = np.zeros((n, 3)), np.zeros((n, 3))
    ahead[0] = emitted[0] + move[OUT]
    for k in range(1, n):
        ahead[k] = emitted[k] + total(ahead[k - 1][:, None] + move)
    behind[-1] = move[:, OUT]
    for k in range(n - 2, -1, -1):
        behind[k] = total((move + emitted[k + 1] + behind[k + 1]).T)
    whole = total(ahead[-1] + behind[-1])
    at = np.exp(ahead + behind - whole)
    changes = np.zeros((3, 3))
    changes[OUT] += at[0]
    changes[:, OUT] += at[-1]
    for k in range(1, n):
        changes += np.exp(ahead[k - 1][:, None] + move + emitted[k] + behind[k] - whole)
    return at, changes


def expected_many(model: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``expected`` for chains of one length: (chains, tokens, 3) gives each token's probabilities and all changes together."""
    move, n = model.transition, emitted.shape[1]
    ahead, behind = np.zeros(emitted.shape), np.zeros(emitted.shape)

    def added(x: np.ndarray) -> np.ndarray:
        top = x.max(axis=1)
        return top + np.log(np.exp(x - top[:, None]).sum(axis=1))

    ahead[:, 0] = emitted[:, 0] + move[OUT]
    for k in range(1, n):
        ahead[:, k] = emitted[:, k] + added(ahead[:, k - 1, :, None] + move)
    behind[:, -1] = move[:, OUT]
    for k in range(n - 2, -1, -1):
        behind[:, k] = added((move + (emitted[:, k + 1] + behind[:, k + 1])[:, None]).transpose(0, 2, 1))
    whole = added(ahead[:, -1] + behind[:, -1])[:, None, None]
    at = np.exp(ahead + behind - whole)
    changes = np.zeros((3, 3))
    changes[OUT] += at[:, 0].sum(axis=0)
    changes[:, OUT] += at[:, -1].sum(axis=0)
    if n > 1:
        changes += np.exp(ahead[:, :-1, :, None] + move + (emitted + behind - whole)[:, 1:, None]).sum(axis=(0, 1))
    return at, changes


def train(examples: list[tuple[list[list[int]], list[int]]], *, epochs: int = 12, rate: float = 0.2, decay: float = 1e-3, together: int = 16) -> Model:
    """Maximum likelihood by adaptive gradient steps, in a fixed order. Nothing to learn from: all is outside.

    A step takes ``together`` examples of one length and the same numbers of features.
    """
    emission, transition = np.zeros((1 << BITS, 3)), np.zeros((3, 3))
    transition[OUT, INSIDE] = -1e9  # a secret starts with its begin
    g_emission, g_transition = np.full((1 << BITS, 3), 1e-8), np.full((3, 3), 1e-8)
    model = Model(emission, transition)
    if not any(t != OUT for _, tags in examples for t in tags):
        emission[:, BEGIN:] = -1.0
        return model
    fixed = transition[OUT, INSIDE]
    alike: dict[tuple[int, int], list[int]] = {}
    for i, (features, tags) in enumerate(examples):
        alike.setdefault((len(tags), len(features[0])), []).append(i)
    packed = [(np.array([examples[i][0] for i in of]), np.array([examples[i][1] for i in of])) for of in alike.values()]
    for epoch in range(epochs):
        r = np.random.default_rng(epoch)
        steps = [(k, part) for k, (_, tags) in enumerate(packed) for order in [r.permutation(len(tags))] for part in np.split(order, range(together, len(order), together))]
        for k, part in (steps[i] for i in r.permutation(len(steps))):
            features, tags = packed[k][0][part], packed[k][1][part]
            at, changes = expected_many(model, emission[features].sum(axis=2))
            path = np.pad(tags, ((0, 0), (1, 1)), constant_values=OUT)
            want = np.bincount((3 * path[:, :-1] + path[:, 1:]).ravel(), minlength=9).reshape(3, 3)
            step = np.eye(3)[tags] - at
            which, place = np.unique(features, return_inverse=True)
            place, size = place.ravel(), features.shape[2]
            g = np.stack([np.bincount(place, np.repeat(step[:, :, t].ravel(), size), len(which)) for t in range(3)], axis=1) - decay * emission[which]
            g_emission[which] += g * g
            emission[which] += rate * g / np.sqrt(g_emission[which])
            g = want - changes - decay * np.where(transition == fixed, 0, transition)
            g[OUT, INSIDE] = 0
            g_transition += g * g
            transition += rate * g / np.sqrt(g_transition)
    return model


class Window(NamedTuple):
    """Tokens to learn from, as in a stretch. kind 0: with secrets; 1: with words that look like them; 2: all others."""

    kind: int
    tokens: list[str]
    joined: list[bool]
    tags: list[int]


def windows(text: str) -> Iterator[Window]:
    """A text's tokens in windows: around the patterns' secrets (of longer ones the begin), and all that lies between."""
    secrets = values(text, base_spans(text))
    alike = [a for c in chains(text) for a, _ in c.spans]
    for part in stretches(text):
        n = len(part.starts)
        tags = tags_of(zip(part.starts.tolist(), part.ends.tolist(), strict=True), secrets) if secrets else [OUT] * n
        starts, joined, hits = part.starts.tolist(), part.joined.tolist(), np.flatnonzero(tags)
        around = np.zeros(n + 2 * ASIDE, bool)
        for d in range(2 * ASIDE + 1):
            around[hits + d] = True
        around = around[ASIDE : n + ASIDE]
        edges = [0, *(np.flatnonzero(around[1:] != around[:-1]) + 1).tolist(), n] if n else []
        for first, last in zip(edges, edges[1:], strict=False):
            size = LONGEST if around[first] else PLAIN
            for a in range(first, last, size):
                b = min(a + size, last)
                while a < b and tags[a] == INSIDE:  # the rest of a longer one
                    a += 1
                if a < b:
                    k = bisect_left(alike, starts[a])
                    kind = 0 if any(tags[a:b]) else 1 if k < len(alike) and alike[k] <= starts[b - 1] else 2
                    yield Window(kind, part.tokens[a : b + 4], joined[a : b + 4], tags[a:b])


def marked(tokens: list[str], joined: list[bool], shared: list[str], tags: list[int]) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Features and tags of a window. One with secrets comes again without its neighbours, so that shapes count alone."""
    own, near = features_of(tokens, joined, shared)
    yield [a + b for a, b in zip(own, near, strict=True)], tags
    if any(tags):
        yield own, tags


def examples_of(text: str, source: str | None) -> Iterator[tuple[list[list[int]], list[int]]]:
    """The windows of a text with their features and tags by the patterns."""
    for _, tokens, joined, tags in windows(text):
        yield from marked(tokens, joined, marks(text, source), tags)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source", max_docs: int = 2000, max_chains: int = 6000) -> Model:
    """The field's weights, from the patterns' matches in a bounded sample.

    ``max_docs`` documents that have an assignment or an access key and ``max_docs`` of all, in order of a hash of the
    id; of their windows ``max_chains`` of each kind (with secrets, with words that look like them, others), in order of
    a hash. Features are made of these windows only, and only their numbers come to the driver.
    """
    rows = picked(docs, id=id_col, text=text_col, **({"source": source_col} if source_col else {}))
    rows = rows if source_col else rows.withColumn("source", F.lit(None).cast("string"))
    order = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")))
    ids = rows.select("id", order.alias("h"))
    having = rows.where(F.col("text").rlike(ASSIGNED) | F.col("text").contains("AKIA")).select("id", order.alias("h"))
    chosen = ids.orderBy("h").limit(max_docs).union(having.orderBy("h").limit(max_docs)).select("id").distinct()
    sample = stored(rows.join(F.broadcast(chosen), "id", "left_semi"), "secret-sample")  # at most 2 * max_docs ids; rows without id don't teach
    schema = "h long, kind int, tokens array<string>, joined array<boolean>, tags array<int>, shared array<string>"
    strings, bools, ints = pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, source in zip(batch["text"], batch["source"].to_pylist(), strict=True):
                text = value.as_py() or ""
                found, shared = list(windows(text)), marks(text, source)
                keys = [zlib.crc32("\n".join(w.tokens).encode()) for w in found]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(x, kind) for x, kind in zip(zip(*found, strict=True) if found else [[]] * 4, (pa.int32(), strings, bools, ints), strict=True)), pa.array([shared] * len(found), strings)], ["h", "kind", "tokens", "joined", "tags", "shared"])

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for w in batch.to_pylist() for e in marked(w["tokens"], w["joined"], w["shared"], w["tags"])]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.list_(ints)), pa.array([t for _, t in found], ints)], ["features", "tags"])

    every = stored(sample.select("text", "source").mapInArrow(cut, schema), "secret-windows")
    some = [every.where(F.col("kind") == kind).orderBy("h", "tokens", "joined", "tags", "shared").limit(max_chains).drop("h", "kind") for kind in range(3)]
    found = some[0].union(some[1]).union(some[2]).mapInArrow(make, "features array<array<int>>, tags array<int>")
    return train([(r["features"], r["tags"]) for r in found.orderBy("features", "tags").collect()])


def surely_out(model: Model, emitted: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Places whose tag is OUT on every best path, by their and the next place's scores alone.

    Take any path with another tag here. Put OUT in its place and, if INSIDE follows, BEGIN there: the new path is legal, and
    where it is better for all tags around, no best path has another tag here. ``more``: the next place isn't known.
    """
    move = model.transition
    into = (move - move[:, [OUT]]).max(axis=0)
    on = (move[:, [OUT, BEGIN]] - move[OUT, [OUT, BEGIN]]).max(axis=1)
    following = np.where(more, np.inf, np.append(emitted[1:, INSIDE] - emitted[1:, BEGIN], np.inf)) + (move[INSIDE] - move[BEGIN]).max()
    gain = [emitted[:, t] - emitted[:, OUT] + into[t] + np.maximum(on[t], move[t, INSIDE] - move[OUT, BEGIN] + following) for t in (BEGIN, INSIDE)]
    return np.maximum(*gain) < -1e-9


class Tagger:
    """Decodes all tokens of texts, many texts at a time. Scores of tokens in each role are kept until there are too many."""

    def __init__(self, model: Model):
        self.model = model
        self.looks: dict[Look | None, int] = {None: 0}
        self.look_sums = [[np.zeros(3)] * 2]
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table, self.held = np.zeros((1024, 8, 3)), 0
        self.numbers([""])  # stands where a text ends

    def score(self, name: str) -> np.ndarray:
        return self.model.emission[hashed(name)]

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """The tokens' rows in the table of scores."""
        found = list(map(self.rows.get, tokens))
        if None in found:
            new = list(dict.fromkeys(t for t, x in zip(tokens, found, strict=True) if x is None))
            first = len(self.rows)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[first : first + len(new)] = self.made(new)
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
            self.held += sum(map(len, new))
            found = [self.rows[t] if x is None else x for t, x in zip(tokens, found, strict=True)]
        return np.array(found, np.int64)

    def made(self, tokens: list[str]) -> np.ndarray:
        """The sums of ``by_role``'s weights for each token. Those of a look are added up once."""
        weights = self.model.emission
        looks, begins, lows = [look(t) if t else None for t in tokens], [f"b{begin(t)}" for t in tokens], [t.lower().encode() for t in tokens]
        for x in set(looks).difference(self.looks):
            if x:
                own = weights[features_of_look(x)].sum(axis=0)
                self.looks[x] = len(self.look_sums)
                self.look_sums.append([own + weights[features_of_gap(g, x.classes)].sum(axis=0) for g in (False, True)])
        out = np.zeros((len(tokens), 8, 3))
        out[:, [APART, JOINED]] = np.array(self.look_sums)[[self.looks[x] for x in looks]] + weights[list(map(named, begins)), None]
        out[[x is None for x in looks], : JOINED + 1] = 0
        seeds = {role: zlib.crc32(role.encode()) for role in "wpqs"}
        of = {role: weights[np.array([zlib.crc32(x, seed) for x in lows], np.int64) & (len(weights) - 1)] for role, seed in seeds.items() if role != "s"}
        out[:, FIRST], out[:, SECOND], out[:, THIRD] = of["p"] + of["w"], of["q"] + of["w"], of["w"]
        out[:, NEXT] = weights[[zlib.crc32(t.lower()[:12].encode(), seeds["s"]) & (len(weights) - 1) for t in tokens]]
        out[:, LEFT] = weights[[named(f"l{t[-1:]}") for t in tokens]]
        out[:, RIGHT] = weights[[named(f"a{t[:1]}") for t in tokens]]
        return out

    def scored(self, parts: list[tuple[Stretch, np.ndarray]]) -> np.ndarray:
        """Scores of all tokens of stretches, each with what its text shares; places around them only as if outside."""
        rows = 8 * self.numbers([t for p, _ in parts for t in p.tokens])
        joined = np.concatenate([p.joined for p, _ in parts])
        flat = self.table.reshape(-1, 3)
        out = flat[rows + joined]
        out += np.repeat([shared for _, shared in parts], [len(p.tokens) for p, _ in parts], axis=0)
        for back, role in ((1, FIRST), (2, SECOND), (3, THIRD)):
            out[back:] += flat[rows[:-back] + role]
        out[:-1] += flat[rows[1:] + NEXT]
        out[1:] += np.where(joined[1:, None], flat[rows[:-1] + LEFT], self.score("l "))
        out[:-1] += np.where(joined[1:, None], flat[rows[1:] + RIGHT], self.score("a "))
        ends = np.cumsum([len(p.tokens) for p, _ in parts])
        firsts = np.append(0, ends[:-1])
        out[[*firsts, *(firsts + 1), *(firsts + 2), *(ends - 1)]] = (0, 0, -1e9)
        return out

    def spans(self, texts: Iterable[tuple[str, str | None]]) -> Iterator[list[tuple[int, int]]]:
        """The secrets of each text with its source: a begin and what is inside after it."""
        group: list[tuple[Stretch, np.ndarray]] = []
        size, self.found, self.run = 0, [], ([], [])
        for text, source in texts:
            shared = sum(map(self.score, marks(text, source)))
            for part in stretches(text):
                group.append((part, shared))
                size += len(part.tokens) + int(part.ends[-1] - part.starts[0]) if len(part.ends) else 4
                if size >= TOGETHER:
                    yield from self.decoded(group)
                    group, size = [], 0
        yield from self.decoded(group)

    def decoded(self, group: list[tuple[Stretch, np.ndarray]]) -> Iterator[list[tuple[int, int]]]:
        if not group:
            return
        emitted = self.scored(group)
        ends = np.cumsum([len(p.tokens) for p, _ in group])
        more = np.zeros(len(emitted), bool)
        more[ends - 2] = [p.more for p, _ in group]
        unsure = np.flatnonzero(~surely_out(self.model, emitted, more))
        lasts = np.searchsorted(unsure, ends - 1)
        for (part, _), end, low, high in zip(group, ends.tolist(), np.searchsorted(unsure, ends - [len(p.tokens) - 3 for p, _ in group]).tolist(), lasts.tolist(), strict=True):
            n, at = len(part.starts), unsure[low:high]
            first = end - 1 - n
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
                if run[0] != first:
                    self.close()
                self.run[0].append(emitted[run])
                self.run[1].extend(zip(part.starts[run - first].tolist(), part.ends[run - first].tolist(), strict=True))
                if run[-1] != end - 2 or not part.more:
                    self.close()
            if not part.more:
                self.close()
                yield self.found
                self.found = []
        if len(self.rows) > ROWS or self.held > KEYS:
            self.clear()

    def close(self) -> None:
        """Decode the tokens between two that are surely outside."""
        if self.run[0]:
            for tag, (start, end) in zip(best_tags(self.model, np.concatenate(self.run[0])), self.run[1], strict=True):
                if tag == BEGIN:
                    self.found.append((start, end))
                elif tag == INSIDE:  # comes after a begin only
                    self.found[-1] = (self.found[-1][0], end)
            self.run = ([], [])


def tagged(model: Model, text: str, source: str | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The field's spans in one text; those that touch a pattern's span are left out."""
    return apart(next(Tagger(model).spans([(text, source)])), base)


def apart(found: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that touch none of the patterns'."""
    kept, held = [], sorted((a, b) for a, _, b in base)
    place, furthest = 0, -1  # spans come in order, so one look at each pattern's span is enough
    for start, end in found:
        while place < len(held) and held[place][0] < end:
            furthest = max(furthest, held[place][1])
            place += 1
        if furthest <= start:
            kept.append((start, 3, end))
    return kept


def scan(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>): the secrets of every whole text, in code points, the end exclusive.

    By start, then kind: assign, access, hex, and ``tagged`` for what the field adds. Null texts have none; repeated
    rows each have a row.
    """
    rows = picked(docs, id=id_col, text=text_col, **({"source": source_col} if source_col else {}))
    rows = rows if source_col else rows.withColumn("source", F.lit(None).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(model.emission.any(axis=1)).astype(np.int32), model.emission[model.emission.any(axis=1)], model.transition))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, transition = shared.value
        emission = np.zeros((1 << BITS, 3))
        emission[places] = weights
        own = Tagger(Model(emission, transition))
        for batch in batches:
            found, sources = [], batch["source"].to_pylist()
            texts = ((value.as_py() or "", source) for value, source in zip(batch["text"], sources, strict=True))
            for value, spans in zip(batch["text"], own.spans(texts), strict=True):
                base = base_spans(value.as_py() or "")
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(base + apart(spans, base))])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, kind)], ["id", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.select("id", "text", "source").mapInArrow(run, f"id {id_type}, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of each pattern's spans, the SHA-256 of them as text, and all spans as text."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(id_col, *(count(k) for k in KINDS[:3]), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), count(KINDS[3]))
