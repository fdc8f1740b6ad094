"""Collocations against plain counting, with small chunks and summaries so that all of their steps happen."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from filing_jobs.llm import phrases
from filing_jobs.llm.phrases import Summary, blocks, chunks, collocations


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def grams(rows):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for part in re.split(r"[.,;:!?\x0A-\x0D]", small(text or "")):
            words = [w for w in part.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            counts.update((lang, " ".join(words[i : i + n])) for n in range(1, 5) for i in range(len(words) - n + 1))
    return counts, total


def plain(rows, least, best):
    counts, total = grams(rows)
    frequent = {k: a for k, a in counts.items() if a >= least and " " in k[1]}
    held = []
    for (lang, phrase), a in frequent.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            x, y = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((2_000_000 * a // (x + y), k, x, y))
        score, _, x, y = min(cuts)
        longer = [b for (g, p), b in frequent.items() if g == lang and p != phrase and f" {phrase} " in f" {p} "]
        if not any(100 * b >= 80 * a for b in longer):
            held.append((lang, -score, -a, phrase.encode(), phrase, x, y))
    out = []
    for lang in {h[0] for h in held}:
        own = sorted(h for h in held if h[0] == lang)
        out += [(lang, rank, p, -a, x, y, total[lang], -s) for rank, (_, s, a, _, p, x, y) in enumerate(own[:best], 1)]
    return sorted(out)


def random_rows(r, n=80):
    vocabulary = ["a", "b", "c", "D", "é", "zé", "of the", "\x00", "x\xa0y", *(f"rare{k}" for k in range(300))]
    mark = lambda: r.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r", ";"])
    word = lambda: r.choice(vocabulary[: r.choice([3, 5, 9, 309])])
    rows = [("".join(word() + mark() for _ in range(r.randint(0, 60))), r.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [(None, "en"), ("", "fr"), (" . ", "fr"), ("A" * 5000, "en"), rows[0], rows[0]]


@pytest.mark.parametrize(("seed", "chunk", "block"), [(1, 2_000_000, 4 << 20), (2, 40, 30), (3, 7, 9)])
def test_collocations_equal_plain_counting(spark, monkeypatch, seed, chunk, block):
    # functions that tasks run take these values along only if they are read here, so the pieces are compared below
    rows = random_rows(random.Random(seed))
    docs = spark.createDataFrame([(t, g, "x", 1, 2) for t, g in rows], "text string, lang string, phrase string, n int, f int").repartition(3)
    found = collocations(docs, least=5, best=40)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(x[c] for c in names) for x in found.collect()) == plain(rows, 5, 40)
    # chunks and blocks of any size give each n-gram once
    monkeypatch.setattr(phrases, "BLOCK", block)
    batch = pa.RecordBatch.from_arrays([pa.array([(t or "").encode() for t, _ in rows], pa.binary()), pa.array([g or "und" for _, g in rows])], ["text", "lang"])
    seen = Counter()
    for t in chunks([batch], chunk):
        for n, _, ok in phrases.levels(t):
            seen.update((t.langs[t.of[p]], b" ".join(t.words[i] for i in t.ids[p : p + n]).decode()) for p in np.flatnonzero(ok[: t.starts]))
    assert seen == grams(rows)[0]


def test_blocks_cut_at_blanks_only(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 8)
    for text in (b"", b"abc", b"abcdefghijklmnop", b"ab cdefghijklmnop qr\tstuvwxyz ", b" " * 40):
        assert b"".join(blocks(text)) == text
        assert [w for b in blocks(text) for w in b.split()] == text.split()


def test_no_documents_give_no_rows(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_summaries_keep_all_that_is_frequent(monkeypatch):
    monkeypatch.setattr(phrases, "MERGED", 50)
    for seed in range(20):
        r, least = random.Random(seed), 10
        stream = [int(r.paretovariate(0.6)) % 4000 for _ in range(6000)]
        summary, exact = Summary(len(stream) // least + 1), Counter(stream)
        parts = [Counter(stream[k : k + 200]) for k in range(0, len(stream), 200)]
        for p in parts:
            summary.add(np.array(list(p), np.uint32), np.array(list(p.values()), np.int64))
        kept = set(summary.reaching(least).tolist())
        assert summary.lost * (summary.capacity + 1) <= len(stream) and len(kept) <= summary.capacity
        assert {k for k, n in exact.items() if n >= least} <= kept
    assert Summary(3).reaching(1).tolist() == []
