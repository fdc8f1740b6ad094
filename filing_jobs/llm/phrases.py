"""Phrase collocations: every frequent phrase of up to four words, its best cut and its place among its language's phrases.

Candidates come from mergeable Misra-Gries summaries. N-grams are dealt to hash partitions; tasks count what they see,
and each partition's counts are merged into a summary whose capacity exceeds the partition's mass divided by the
threshold. What such a summary loses of a count is less than the threshold, so every n-gram that reaches it survives.
The survivors of all partitions are bits of one filter of fixed size; a last reading counts the n-grams that pass it,
as phrases and exactly. Phrases of three and four words only take part where their pairs have survived, since a phrase
is never more frequent than its parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked, stored, while_stored

#: Words of a phrase at most.
LONGEST = 4
#: Tokens that a task counts at a time, and bytes of a text taken at a time.
CHUNK, BLOCK = 1_000_000, 4 << 20
#: Entries that are merged into a summary at a time, besides those that it holds.
MERGED = 1 << 20
#: N-grams of a hash partition, about; and the most hash partitions, as a power of two: beyond that their summaries grow.
MASS, MOST = 1 << 23, 16
#: The filter has 2^27 bits (16 MB), whatever the input.
BITS = 27
#: What ends a piece becomes one of them, which no word holds; capitals become small.
ENDS = b".,;:!?\n\x0b\x0c\r"
SMALL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(ENDS))
SUMMARY = "bucket int, mass long, keys binary, counts binary"
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Tokens(NamedTuple):
    """Texts as numbers: ``ids`` are places in ``words``, 0 ends a piece; ``of`` has each token's place in ``langs``.

    N-grams that begin at ``starts`` or later belong to the next chunk, which repeats those tokens.
    """

    langs: list[str]
    words: list[bytes]
    ids: np.ndarray
    of: np.ndarray
    starts: int


class Numbered(dict):
    """Numbers words as they come; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks(text: bytes) -> Iterator[bytes]:
    """The text in parts that end at a blank, so that no word is cut."""
    at = 0
    while len(text) - at > BLOCK:
        end = max(text.rfind(b" ", at, at + BLOCK), text.rfind(b"\t", at, at + BLOCK)) + 1
        if end <= at:  # a longer word: it ends at the next blank, if any
            found = [x for x in (text.find(b" ", at + BLOCK), text.find(b"\t", at + BLOCK)) if x >= 0]
            end = min(found) + 1 if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK) -> Iterator[Tokens]:
    """The tokens of all texts, so many at a time. A text longer than a chunk goes on in the next one."""
    numbers, langs, parts, of, n = Numbered(), {}, [], [], 0

    def out(repeated: int) -> Tokens:
        ids = np.concatenate(parts)
        return Tokens(list(langs), list(numbers), ids, np.repeat(np.array([k for k, _ in of], np.int32), [m for _, m in of]), len(ids) - repeated)

    for batch in batches:
        for value, lang in zip(batch["text"], batch["lang"].to_pylist(), strict=True):
            own = 0  # tokens of this text in this chunk
            for found in chain((b.translate(SMALL).replace(b".", b" . ").split() for b in blocks(value.as_py())), [[b"."]]):
                if n and n + len(found) > size:
                    # the last tokens are repeated where the text goes on, so that n-grams over the cut are seen once
                    done = out(min(own, LONGEST - 1))
                    yield done
                    found = [done.words[i] for i in done.ids[done.starts :]] + found
                    numbers, langs, parts, of, n, own = Numbered(), {}, [], [], 0, 0
                if found:
                    parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    of.append((langs.setdefault(lang, len(langs)), len(found)))
                    n += len(found)
                    own += len(found)
    if n:
        yield out(0)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * C2
    return x ^ (x >> np.uint64(29))


def levels(t: Tokens) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1 to 4: n, 64 bits of the n-gram that begins at each token, with its language, and whether one does."""
    word = np.fromiter(map(xxhash.xxh64_intdigest, t.words), np.uint64, len(t.words))[t.ids]
    own = word ^ np.fromiter((xxhash.xxh64_intdigest(x.encode(), 1) for x in t.langs), np.uint64, len(t.langs))[t.of]
    good = first = t.ids != 0
    for n in range(1, LONGEST + 1):
        if n > 1:
            own = mixed(own[:-1] * C1 + word[n - 1 :] + np.uint64(n))
            good = good[:-1] & first[n - 1 :]
        yield n, mixed(own), good


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def summaries(rows: DataFrame, sizes: tuple[int, ...], power: int, bits: object | None) -> DataFrame:
    """Counts of n-grams of ``sizes`` by hash partition: rows (bucket, mass, keys, counts), one of each chunk and bucket.

    A key is the 32 bits of an n-gram's hash behind those of its bucket; n-grams that share both count as one, which
    can only make more of them survive. With ``bits`` only n-grams whose pairs all pass take part.
    """
    names = [x.split()[0] for x in SUMMARY.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches):
            found, pair = [], None
            for n, h, ok in levels(t):
                if bits is not None and n == 2:
                    pair = ok & passes(bits.value, h)
                if n in sizes:
                    if pair is not None:
                        for k in range(n - 1):
                            ok = ok & pair[k : len(ok) + k]
                    found.append(h[: t.starts][ok[: t.starts]] >> np.uint64(32 - power))
            keys = np.concatenate(found)
            del found, pair, h, ok
            keys.sort()
            firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            counts = np.diff(firsts, append=len(keys)).astype("<u4")
            keys = keys[firsts]
            bucket, low = (keys >> np.uint64(32)).astype(np.int64), keys.astype("<u4")
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else []
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            for at in range(0, len(spans), 4096):
                some = spans[at : at + 4096]
                columns = [pa.array([int(bucket[a]) for a, _ in some], pa.int32()), pa.array([int(counts[a:b].sum(dtype=np.int64)) for a, b in some], pa.int64()), pa.array([low[a:b].tobytes() for a, b in some], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in some], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, SUMMARY)


class Summary:
    """A Misra-Gries summary that others are merged into; at most ``capacity`` keys stay after each merge.

    ``lost`` is what was taken off all keys so far: no count is short by more, and it is at most mass / (capacity + 1).
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(MERGED, self.capacity):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[firsts], np.add.reduceat(counts, firsts) if len(keys) else counts
        if len(self.keys) > self.capacity:
            least = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            stay = self.counts > least
            self.keys, self.counts = self.keys[stay], self.counts[stay] - least
            self.lost += least

    def reaching(self, least: int) -> np.ndarray:
        """The keys whose count may be ``least`` or more."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def survivors(found: DataFrame, power: int, least: int) -> np.ndarray:
    """The filter's bits: the keys of each hash partition that a summary of sufficient capacity keeps.

    ``found`` is stored. Each bucket comes to one task, whose rows are merged one after the other. To the driver go the masses of at most 2^16 buckets, and the filter's 16 MB.
    """
    masses = {r["bucket"]: r["mass"] for r in found.groupBy("bucket").agg(F.sum("mass").alias("mass")).collect()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, summary = None, Summary(0)

        def out() -> pa.RecordBatch:
            own = np.zeros(1 << (BITS - power), bool)
            own[summary.reaching(least) >> np.uint32(32 - (BITS - power))] = True
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], ["bucket", "bits"])

        for batch in batches:
            for b, keys, counts in zip(batch["bucket"].to_pylist(), batch["keys"], batch["counts"], strict=True):
                if b != bucket:
                    if bucket is not None:
                        yield out()
                    bucket, summary = b, Summary(masses[b] // least + 1)
                summary.add(np.frombuffer(keys.as_buffer(), "<u4"), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
        if bucket is not None:
            yield out()

    dealt = found.select("bucket", "keys", "counts").repartitionById(1 << power, F.col("bucket"))
    bits, width = np.zeros(1 << (BITS - 3), np.uint8), 1 << (BITS - power - 3)
    for r in dealt.mapInArrow(run, "bucket int, bits binary").collect():
        bits[r["bucket"] * width : (r["bucket"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return bits


def counted(rows: DataFrame, bits: object) -> DataFrame:
    """(lang, phrase, n, f) of each chunk: the n-grams that pass with all their parts; n = 0 has the number of words.

    Here n-grams are named by their words' numbers, not by hashes, so counts are exact.
    """

    def of_chunk(t: Tokens) -> Iterator[pa.RecordBatch]:
        words, ids = len(t.words), t.ids
        name = t.of.astype(np.int64) * words + ids  # exact: language and word
        before = None
        for n, h, ok in levels(t):
            if n == 1:
                totals = np.bincount(t.of[: t.starts][ok[: t.starts]], minlength=len(t.langs))
                kept = np.flatnonzero(totals)
                yield batch_of([t.langs[k] for k in kept], [b""] * len(kept), 0, totals[kept])
            good = ok & passes(bits.value, h)
            if before is not None:
                good &= before[: len(good)] & before[1 : len(good) + 1]
            at = np.flatnonzero(good[: t.starts])
            own, first, place, times = np.unique(name[at], return_index=True, return_inverse=True, return_counts=True)
            where = at[first].tolist()
            texts = [b" ".join([t.words[i] for i in ids[p : p + n]]) for p in where] if n > 1 else [t.words[ids[p]] for p in where]
            for k in range(0, len(where), 50_000):
                yield batch_of([t.langs[i] for i in t.of[at[first[k : k + 50_000]]]], texts[k : k + 50_000], n, times[k : k + 50_000])
            if n < LONGEST:
                name = np.zeros(max(len(ids) - n, 0), np.int64)
                inside = at[at < len(name)]
                name[inside] = place[: len(inside)] * words + ids[inside + n]
            before = good

    def batch_of(langs: list[str], phrases: list[bytes], n: int, times: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string(), safe=False), pa.array(np.full(len(langs), n, np.int32)), pa.array(times.astype(np.int64))], ["lang", "phrase", "n", "f"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches):
            yield from of_chunk(t)

    return rows.mapInArrow(run, "lang string, phrase string, n int, f long")


def frequent(docs: DataFrame, least: int, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, n, f): all phrases of 1 to 4 words with f >= ``least``, and of each language the number of words (n = 0).

    Null text counts as empty, a null language as ``und``; repeated rows each count.
    """
    spark = docs.sparkSession
    rows = picked(docs, text=text_col, lang=lang_col).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    power = min(MOST, max(5, int(size // (3 * MASS)).bit_length()))  # pairs and words: about one n-gram for three bytes
    with while_stored(summaries(rows, (1, 2), power, None), "phrase-summaries") as found:
        pairs = survivors(found, power, least)
    shared = spark.sparkContext.broadcast(pairs)
    with while_stored(summaries(rows, (3, 4), power, shared), "phrase-summaries") as found:
        longer = survivors(found, power, least)
    bits = spark.sparkContext.broadcast(pairs | longer)
    return counted(rows, bits).groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f")).where((F.col("n") == 0) | (F.col("f") >= least))


def collocations(docs: DataFrame, *, least: int = 30, best: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``best`` phrases of 2 to 4 words: lang, rank, phrase, a, l, r, n, score.

    A phrase is cut where a / (l + r) is least, ties after the fewest words; dropped are phrases inside a longer one
    with at least 80 % of their occurrences. Order: score, then a, both descending, then the phrase's bytes. Texts
    without words give nothing, and an empty table no rows.
    """
    held = stored(frequent(docs, least, text_col=text_col, lang_col=lang_col), "phrases")
    totals = held.where("n = 0").select("lang", F.col("f").alias("total"))
    known = held.where("n > 0")
    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    wide = known.where("n > 1").withColumnRenamed("f", "a")
    cut = wide.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("rest"))
    cut = cut.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("c"))
    # what a longer phrase holds: all its contiguous parts of two words or more
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("n") - m + 1), lambda s: F.array_join(F.slice(words, s, m), " "))))
    held_by = wide.where("n > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(held_by, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * 80))
    ranked = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
    # first the best of each of 64 parts of a language, so that a large language is no single sort
    for keys in ("lang, pmod(xxhash64(phrase), 64)", "lang"):
        ranked = ranked.withColumn("rank", F.expr(f"row_number() over (partition by {keys} order by score desc, a desc, phrase)")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
