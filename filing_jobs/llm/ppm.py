"""Language-model scores by prediction by partial matching, beside a word unigram.

The model is a byte trie up to ORDER bytes of context, trained on all training texts: counts of every
(ORDER + 1)-gram, from which the shorter orders follow. A symbol is predicted in the longest context
that was seen; if it was not seen there, the context's escape probability is paid and the next shorter
context predicts among the symbols that the longer one has not excluded. Below order 0 all symbols
that are left are equally likely.

Scores are those of the whole model, which stays in tables and grows with the corpus. To the executors
go the probabilities of at most ``max_grams`` grams, the most frequent ones; all others are joined by gram.
``train`` gives the same model as a trie in memory, or, if that is bounded, a pruned one: what is left
out adds to its context's escape, so probabilities sum to 1.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import bounding_count, id_remainder, stored

ORDER = 5
SYMBOLS = 256
#: The end of a text, as a byte that no word holds, and as a word of the unigram.
END, END_WORD = b"\n", ""
FLUSH = 1 << 22
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """ASCII lower case, split at ASCII white space; null counts as empty."""
    return text.encode().lower().split() if text else []


def codes_of(words: list[bytes], order: int) -> np.ndarray:
    """The gram of each symbol of the normalised text and its end: ``order`` bytes before it and itself."""
    data = np.frombuffer(END * order + b" ".join(words) + END, "u1").astype("u8")
    n = len(data) - order
    codes = data[:n].copy()
    for k in range(1, order + 1):
        codes = codes << np.uint64(8) | data[k : k + n]
    return codes


class Table:
    """A hash table from 64-bit keys to places 0..n-1; looks up whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.place = np.zeros(1 << bits, "u8"), np.full(1 << bits, -1, "i4")
        slot, left = self._slot(keys), np.arange(len(keys), dtype="i4")
        while len(left):
            free = self.place[slot] < 0
            self.place[slot[free]] = left[free]  # the last of those that want a slot has it
            self.keys[slot[free]] = keys[left[free]]
            lost = self.place[slot] != left
            slot, left = (slot[lost] + 1) & self.mask, left[lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * GOLDEN >> self.shift).astype("i8")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, or -1."""
        slot = self._slot(keys)
        found = self.place[slot]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            now = self.place[slot[wrong]]
            found[wrong] = now
            wrong = wrong[(now >= 0) & (self.keys[slot[wrong]] != keys[wrong])]
        return found


class Trie:
    """Predicts symbols from the counts of grams: ``grams[j]`` has (codes, counts) of j bytes of context and a symbol.

    ``totals[j]`` has (contexts, counts of all their symbols, also of those that ``grams`` leaves out).
    """

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], totals: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(grams) - 1
        self.grams, self.contexts, self.direct, self.after = [], [], [], []
        self.escape, self.escape_after, self.scale_after = [], [], []
        below = None
        for j, ((codes, counts), (names, sums)) in enumerate(zip(grams, totals, strict=True)):
            contexts, of = np.unique(codes >> np.uint64(8), return_inverse=True)
            n = np.zeros(len(contexts))
            order = np.argsort(names)
            if len(contexts):
                n = sums[order][np.searchsorted(names[order], contexts)].astype(float)
            q = np.bincount(of, minlength=len(contexts)).astype(float)
            kept = np.bincount(of, weights=counts, minlength=len(contexts))
            with np.errstate(divide="ignore"):
                self.direct.append(np.log10(counts / (n + q)[of]) if len(of) else np.zeros(0))
                self.escape.append(np.log10((n - kept + q) / (n + q)))
            table, context_table = Table(codes), Table(contexts)
            scale, escape_after = np.zeros(len(contexts)), np.zeros(len(contexts))
            if below is not None:
                # in the shorter context only symbols count that this one has not seen
                b_table, b_counts, b_context, b_n, b_q, b_kept = below
                mask = np.uint64((1 << 8 * j) - 1)
                seen = np.bincount(of, weights=b_counts[b_table.find(codes & mask)], minlength=len(contexts)) if len(of) else np.zeros(0)
                at = b_context.find(contexts & np.uint64((1 << 8 * (j - 1)) - 1)) if j > 1 else np.zeros(len(contexts), "i4")
                left, fresh, held = b_n[at] - seen, b_q[at] - q, b_kept[at] - seen
                whole = left + fresh
                with np.errstate(divide="ignore", invalid="ignore"):
                    scale = np.where(whole > 0, np.log10(whole), np.nan)  # nan: nothing new there, go on without cost
                    escape_after = np.log10((left - held + fresh) / whole)
            below = table, counts.astype(float), context_table, n, q, kept
            self.grams.append(table)
            self.contexts.append(context_table)
            self.after.append(np.log10(counts) if len(counts) else np.zeros(0))
            self.scale_after.append(scale)
            self.escape_after.append(escape_after)
        self.rest = -math.log10(SYMBOLS - len(grams[0][0])) if len(grams[0][0]) < SYMBOLS else 0.0

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol after its context."""
        out, open_ = np.zeros(len(codes)), None
        came = np.zeros(0, "i4")
        for j in range(self.order, -1, -1):
            own = codes if open_ is None else codes[open_]
            if j < 7:
                own = own & np.uint64((1 << 8 * (j + 1)) - 1)
            place = self.grams[j].find(own)
            if open_ is None:
                hit = place >= 0
                out[hit] = self.direct[j][place[hit]]
                open_ = np.flatnonzero(~hit)
                own, came = own[~hit], np.full(len(open_), -1, "i4")
            else:
                scale = self.scale_after[j + 1][came] if len(self.scale_after[j + 1]) else np.zeros(len(came))
                after = came >= 0  # reached by an escape: what the longer context has seen is excluded
                hit = place >= 0
                out[open_[hit]] += np.where(after[hit], self.after[j][place[hit]] - np.where(after[hit], scale[hit], 0), self.direct[j][place[hit]])
                miss = ~hit
                paid = np.zeros(len(came))
                if len(self.escape_after[j + 1]):
                    paid = np.where(after & ~np.isnan(scale), self.escape_after[j + 1][came], 0)
                out[open_[miss & after]] += paid[miss & after]
                open_, own, came = open_[miss], own[miss], np.where(after, 1, -1).astype("i4")[miss]
            context = self.contexts[j].find(own >> np.uint64(8)) if j else np.full(len(own), 0 if len(self.escape[0]) else -1, "i4")
            first = (context >= 0) & (came < 0)  # the longest seen context: its own escape
            out[open_[first]] += self.escape[j][context[first]]
            came = context
            if not len(open_):
                break
        out[open_] += self.rest
        return out


def gram_tables(rows: DataFrame, order: int) -> list[DataFrame]:
    """(gram, c) of all texts of rows (t), for 0 to ``order`` bytes of context and a symbol."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            codes, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.view("i8")), pa.array(c.astype("i8"))], ["gram", "c"])

        for batch in batches:
            for text in batch["t"].to_pylist():
                held.append(codes_of(words_of(text), order))
                size += len(held[-1])
                if size >= FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    longest = stored(rows.select("t").mapInArrow(count, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")), "grams")
    counted = [longest] * (order + 1)
    for j in range(order - 1, -1, -1):  # forget the first byte of the context
        mask = F.lit((1 << 8 * (j + 1)) - 1)
        counted[j] = stored(counted[j + 1].groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("c").alias("c")), f"grams{j}")
    return counted


def train(rows: DataFrame, *, order: int = ORDER, max_grams: int = 1 << 20) -> Trie:
    """The trie of all texts of rows (t) in memory; no rows give an empty trie, which predicts all symbols alike."""
    counted = gram_tables(rows, order)
    least = max(bounding_count(g, max_grams) for g in counted)
    grams, totals = [], []
    for g in counted:
        kept = g.where(F.col("c") >= least).select("gram", "c", F.shiftrightunsigned("gram", 8).alias("context"))
        own = kept.toArrow()
        contexts = g.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(F.sum("c").alias("n"), F.max("c").alias("most")).where(F.col("most") >= least).toArrow()
        grams.append((own["gram"].to_numpy().astype("i8").view("u8"), own["c"].to_numpy().astype("i8")))
        totals.append((contexts["context"].to_numpy().astype("i8").view("u8"), contexts["n"].to_numpy().astype("i8")))
    return Trie(grams, totals)


def context_of(gram: Column, j: int | None = None) -> Column:
    """The bytes before the gram's symbol, or the last ``j`` of them."""
    whole = F.shiftrightunsigned(gram, 8)
    return whole if j is None else whole.bitwiseAND(F.lit((1 << 8 * j) - 1))


def contexts(counted: list[DataFrame], j: int) -> DataFrame:
    """(context, n, q, seen) of j > 0 bytes: all its symbols, the distinct ones, and how often those follow the shorter context."""
    below = counted[j - 1].toDF("below", "b")
    return counted[j].join(below, F.col("gram").bitwiseAND(F.lit((1 << 8 * j) - 1)) == F.col("below")).groupBy(context_of(F.col("gram")).alias("context")).agg(F.sum("c").alias("n"), F.count("*").alias("q"), F.sum("b").alias("seen"))


def unseen_logs(grams: DataFrame, counted: list[DataFrame], longest: DataFrame) -> DataFrame:
    """(gram, log) of grams of the longest order that no training text has; ``longest``: the contexts of that order."""
    order = len(counted) - 1
    n0, q0 = counted[0].agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    of = {0: (F.lit(n0), F.lit(q0), None)} if n0 else {}
    for j in range(order, 0, -1):
        if not n0:
            break
        bounded = F.broadcast if j < 2 else lambda df: df  # 256 contexts, 65536 grams
        table = (longest if j == order else contexts(counted, j)).toDF(f"k{j}", f"n{j}", f"q{j}", f"s{j}")
        grams = grams.join(bounded(table), context_of(F.col("gram"), j) == F.col(f"k{j}"), "left")
        bounded = F.broadcast if j < 3 else lambda df: df
        grams = grams.join(bounded(counted[j - 1].toDF(f"g{j - 1}", f"c{j - 1}")), F.col("gram").bitwiseAND(F.lit((1 << 8 * j) - 1)) == F.col(f"g{j - 1}"), "left")
        of[j] = F.col(f"n{j}"), F.col(f"q{j}"), F.col(f"s{j}")
    # without: what is paid from here down if no longer context was seen; after: if the next longer one was
    rest = F.lit(-math.log10(SYMBOLS - q0) if q0 < SYMBOLS else 0.0)
    without = after = rest
    for j in range(len(of)):
        n, q, _ = of[j]
        c = F.col(f"c{j}") if j < order else F.lit(None).cast("long")
        own = F.when(c.isNotNull(), F.log10(c / (n + q))).otherwise(F.log10(q / (n + q)) + after)
        without = own if not j else F.when(n.isNotNull(), own).otherwise(without)
        if j < order:
            _, longer, seen = of[j + 1]
            fresh = q - longer
            whole = n - seen + fresh
            paid = F.when(whole > 0, F.log10(fresh / whole)).otherwise(0.0)
            after = F.when(c.isNotNull(), F.log10(c) - F.log10(whole)).otherwise(paid + after)
    return grams.select("gram", without.alias("log"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) of all tokens of rows (t); END_WORD stands for the ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in batches:
            for text in batch["t"].to_pylist():
                held.update(words_of(text))
                held[END_WORD.encode()] += 1
                if len(held) > 500_000:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return rows.select("t").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score(df: DataFrame, learns: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, max_grams: int = 1 << 20,
          max_words: int = 1 << 17) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Models learn from all rows for which ``learns`` holds. ``base_score``: add-one word unigram;
    ``score``: the whole model's log10 probability of the text in ASCII lower case, its words joined by
    single blanks, and its end. Null counts as empty; null ids and repeated rows each have their own row.
    The ``max_words`` most frequent words and the ``max_grams`` most frequent grams go to the executors;
    all others are joined and added up by row. No training text: every byte is equally likely.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"), F.coalesce(learns, F.lit(False)).alias("learns"))
    training = rows.where("learns")
    words = stored(word_counts(training), "words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = bounding_count(words, max_words)
    often = words.where(F.col("c") >= least).toArrow()
    frequent = {w.encode(): c for w, c in zip(often["word"].to_pylist(), often["c"].to_pylist(), strict=True)}
    for row in words.where(F.col("word") == END_WORD).collect():
        frequent[END_WORD.encode()] = row["c"]
    context = df.sparkSession.sparkContext
    counted = gram_tables(training, order)
    longest = stored(contexts(counted, order), "contexts")
    least_gram = bounding_count(counted[order], max_grams)
    direct = counted[order].join(longest, context_of(F.col("gram")) == F.col("context")).select("gram", "c", F.log10(F.col("c") / (F.col("n") + F.col("q"))).alias("log"))
    top = direct.where(F.col("c") >= least_gram).select("gram", "log").toArrow()
    table = Table(top["gram"].to_numpy().astype("i8").view("u8")), top["log"].to_numpy().astype("f8")
    grams, common = context.broadcast(table), context.broadcast(frequent)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (places, values), known = grams.value, common.value
        logs = {w: math.log10(c + 1) for w, c in known.items()}
        for batch in batches:
            tokens, found, base, own, rest, times, names, often = [], [], [], [], [], [], [], []
            for text in batch["t"].to_pylist():
                split = words_of(text)
                each = [x for w in (*split, b"") if (x := logs.get(w)) is not None]
                tokens.append(len(split) + 1)
                found.append(len(each))
                base.append(math.fsum(each))
                others = Counter(w for w in split if w not in logs)
                names.append([w.decode() for w in others])
                often.append(list(others.values()))
                codes = codes_of(split, order)
                place = places.find(codes)
                hit = place >= 0
                own.append(float(values[place[hit]].sum()))
                left, each = np.unique(codes[~hit], return_counts=True)
                rest.append(left.view("i8"))
                times.append(each)
            longs = pa.list_(pa.int64())
            columns = zip((tokens, found, base, own, rest, times, names, often), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), longs, longs, pa.list_(pa.string()), longs), strict=True)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["learns"], *(pa.array(x, kind) for x, kind in columns)], ["id", "learns", "n_tokens", "found", "base", "own", "grams", "times", "words", "often"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(whole, f"id {kind}, learns boolean, n_tokens long, found long, base double, own double, grams array<long>, times array<long>, words array<string>, often array<long>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = scored.select("row", "learns", F.explode(F.arrays_zip("grams", "times")).alias("g")).select("row", "learns", F.col("g.grams").alias("gram"), F.col("g.times").alias("times"))
    new = stored(asked.where("not learns").select("gram").distinct().join(counted[order], "gram", "left_anti"), "unseen")  # a text that is learnt has none
    others_logs = direct.where(F.col("c") < least_gram).select("gram", "log").union(unseen_logs(new, counted, longest))
    gram_logs = asked.join(others_logs, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("gram_logs"))
    rare = scored.select("row", F.explode(F.arrays_zip("words", "often")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.often").alias("times"))
    word_logs = rare.join(words.where(F.col("c") < least), "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs"))
    joined = scored.drop("grams", "times", "words", "often").join(gram_logs, "row", "left").join(word_logs, "row", "left")
    return joined.select(
        F.col("id").alias(id_col),
        (~F.col("learns")).alias("held_out"),
        "n_tokens",
        (F.col("found") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("own") + F.coalesce("gram_logs", F.lit(0.0))).alias("score"),
    )


def learning(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 7, is not 2."""
    return id_remainder(id_col, 7) != 2
