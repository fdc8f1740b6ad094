"""The Jaccard join and connected components against brute force."""

import random
import re

import pytest

from filing_jobs.llm import jaccard
from filing_jobs.llm.components import components


def brute_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def closed(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in nodes}


def brute(rows):
    sets = {i: brute_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in closed(ids, links).items()}


def corpus(seed):
    r = random.Random(seed)
    words = [f"{c}{k}" for c in "abÉ中" for k in range(40)]
    passage = [r.choice(words) for _ in range(30)]
    texts = [None, "", " \t", "one", "ONE", "one two", "One two", "a b c d e", "a b c d e f", "word " * 3000]
    bases = [[r.choice(words) for _ in range(r.choice([3, 6, 9, 25, 60, 200]))] for _ in range(25)]
    for _ in range(170):
        own = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
            own[r.randrange(len(own))] = r.choice(words)
        if r.random() < 0.3:
            own = own + passage
        if r.random() < 0.2:
            own = own[: r.randint(1, len(own))]
        texts.append(" ".join(w.upper() if r.random() < 0.1 and w.isascii() else w for w in own))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 3)])
def test_join_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    if block < 10:
        monkeypatch.setattr(jaccard, "HOME", 12)
        monkeypatch.setattr(jaccard, "REMEMBER", 3)
        monkeypatch.setattr(jaccard, "FLUSH", 500)
        monkeypatch.setattr(jaccard, "FREQUENT", 20)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, node string, n int, id int").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    want = brute(rows)
    assert got == want and len({c for _, c in want.values()}) < len(rows) - 30
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_join_of_little(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(empty).count() == 0 and jaccard.keep_first(empty).count() == 0
    same = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, "z")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.join(same).collect()), key=str)
    assert got == sorted([(7, 3), (7, 3), (3, 3), (None, 3), (None, None), (9, 9)], key=str)
    assert sorted((r["doc_id"] for r in jaccard.keep_first(same).collect()), key=str) == sorted([3, 9, None, None], key=str)


def test_repeated_id_with_different_texts(spark):
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (4, "c d e f g h")]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_null_ids_among_near_copies(spark):
    rows = [(None if i % 3 == 1 else i, t) for i, t in corpus(3)]
    want = brute([(i, t) for i, t in rows if i is not None])
    equal = {frozenset(brute_set(t)): want[i][1] for i, t in rows if i is not None and brute_set(t)}
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    nulls = [equal.get(frozenset(brute_set(t))) for i, t in rows if i is None]
    assert sorted(map(str, nulls)) == sorted(str(r["component_id"]) for r in got if r["doc_id"] is None)


def test_components(spark):
    r = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 140)]
    edges = chain + [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(-5, -5), (7, 200), (200, 7)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in closed(sorted(nodes | {-5}), edges).items() if k in nodes}


def test_bounds():
    a, b = jaccard.shingles(" ".join(map(str, range(300)))), jaccard.shingles(" ".join(map(str, range(20, 330))))
    assert len(a) == 296 and jaccard.differing_bits(jaccard.bitmap_of(a), jaccard.bitmap_of(b)) <= len(set(a.tolist()) ^ set(b.tolist()))
    assert jaccard.prefix_length(1) == 1 and jaccard.prefix_length(4) == 2 and jaccard.shingles(None).size == 0
    assert jaccard.may_link(200, 28) and not jaccard.may_link(200, 29)
