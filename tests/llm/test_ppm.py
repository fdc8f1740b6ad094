"""The byte trie and the word unigram against direct computations."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filing_jobs.llm import ppm

TEXTS = [None, "", "  \n", "a", "The cat sat on the mat.", "the CAT sat", "ÀB àb", "x" * 2000, "word " * 4000, "the cat sat on the mat."]


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [""]


def slow_logs(symbols, texts, order, least=1):
    """Prediction by partial matching written out for one text."""
    counts = Counter()
    for t in texts:
        data = b"\n" * order + t
        for k in range(order, len(data)):
            for j in range(order + 1):
                counts[data[k - j : k], data[k]] += 1
    kept = {key: c for key, c in counts.items() if c >= least}
    data, total = b"\n" * order + symbols, 0.0
    for k in range(order, len(data)):
        excluded, j = set(), order
        while True:
            if j < 0:
                total -= math.log10(256 - len(excluded))
                break
            context = data[k - j : k]
            own = {s: c for (x, s), c in kept.items() if x == context}
            if own:
                everything = sum(c for (x, s), c in counts.items() if x == context and s not in excluded)
                fresh = {s: c for s, c in own.items() if s not in excluded}
                whole = everything + len(fresh)
                if data[k] in fresh:
                    total += math.log10(fresh[data[k]] / whole)
                    break
                if whole:
                    total += math.log10((everything - sum(fresh.values()) + len(fresh)) / whole)
                excluded |= set(own)
            j -= 1
    return total


@pytest.mark.parametrize("order,max_grams", [(0, 1 << 20), (2, 1 << 20), (3, 40)])
def test_trie_equals_the_definition(spark, order, max_grams):
    r = random.Random(2)
    texts = ["".join(r.choice("abc d") for _ in range(r.randint(0, 30))) for _ in range(30)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    trie = ppm.train(df, order=order, max_grams=max_grams)
    normal = [b" ".join(ppm.words_of(t)) + b"\n" for t in texts]
    least = 1
    if max_grams < 1000:
        for j in range(order + 1):
            counts = Counter((order * b"\n" + t)[k + order - j : k + order + 1] for t in normal for k in range(len(t)))
            if len(counts) > max_grams:
                least = max(least, min(c for c in set(counts.values()) if sum(x >= c for x in counts.values()) <= max_grams))
        assert least > 1
    for text in ["abc d", "", "zz a", "ab zab", "cab d dab"]:
        own = ppm.words_of(text)
        assert trie.logs(ppm.codes_of(own, order)).sum() == pytest.approx(slow_logs(b" ".join(own) + b"\n", normal, order, least))
    context = ppm.codes_of([b"ab", b"c"], order)[2] << np.uint64(8) & np.uint64((1 << 8 * (order + 1)) - 1)
    assert (10 ** trie.logs(context | np.arange(256, dtype="u8"))).sum() == pytest.approx(1)


@pytest.mark.parametrize("max_words", [0, 3, 1000])
def test_score(spark, max_words):
    rows = list(enumerate(TEXTS * 3)) + [(4, TEXTS[4]), (None, "the cat"), (0, None)]
    df = spark.createDataFrame([(i, t, True, "h") for i, t in rows], "doc_id long, text string, learns boolean, h string").repartition(4)
    got = ppm.score(df, ppm.learning(), max_words=max_words, order=3).collect()
    train = [t for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 7 != 2]
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    text_of = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        tokens = words(text_of[r["doc_id"]])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in c for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)) and r["score"] < 0


@pytest.mark.parametrize("max_grams", [0, 5, 1000])
def test_scores_are_those_of_the_whole_model(spark, max_grams):
    rows = [*enumerate(TEXTS * 3), (50, "zz cat"), (51, "the\u00e9 sat"), (52, "abcabd cab"), (53, "abcabd cab"), (53, "abcabd cab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    learns = F.col("doc_id") < 40
    trie = ppm.train(df.where(learns).select(F.col("text").alias("t")), order=3, max_grams=1 << 20)
    got = ppm.score(df, learns, order=3, max_grams=max_grams).collect()
    want = {i: trie.logs(ppm.codes_of(ppm.words_of(t), 3)).sum() for i, t in rows}
    assert len(got) == len(rows) and all(r["score"] == pytest.approx(want[r["doc_id"]]) for r in got)


def test_score_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.score(empty, ppm.learning()).count() == 0
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    (r,) = ppm.score(one, F.lit(False)).collect()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0) and r["score"] == pytest.approx(-3 * math.log10(256))


def test_table():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000).astype("u8"))
    table = ppm.Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys + np.uint64(1 << 41)) == -1).all()
