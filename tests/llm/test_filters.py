"""The filter audit against a plain loop over documents, orders and steps."""

import random
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from filing_jobs.llm import filters
from filing_jobs.llm.filters import FILTERS, audit, mask_of, shapley_weights

ASCII = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in ASCII[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(rows, labels):
    """{(part, order, step): counts}, straight from the definitions."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, part in rows:
        text, part = text or "", part or ""
        w = words_of(text)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": any((t or "") == text and j is not None and i is not None and j < i for j, t, _ in rows),
        }
        docs.append((part, {f for f in FILTERS if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own, total = [d for d in docs if d[0] == part], dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                earlier = sum(f in d[1] for d in own) - len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), earlier, sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return out


def texts(r):
    vocabulary = [f"w{k}" for k in range(400)] + ["ABC", "Über", "#x", "a|b", "中文", "\x85", "x\xa0y"]
    return " ".join(r.choice(vocabulary[: r.choice([30, 400, 407])]) for _ in range(r.choice([0, 5, 99, 100, 130])))


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_a_plain_loop(spark, seed):
    r = random.Random(seed)
    pool = [None, "", "A" * 9, "A" * 10 + "b" * 90, "\x0b".join(["w"] * 100)] + [texts(r) for _ in range(12)]
    rows = [(r.choice([None, *range(25)]), r.choice(pool), r.choice([None, "", "en", "de"])) for _ in range(60)]
    labels = [(r.randrange(30), r.choice([0, 1, None]), r.choice([0, 1])) for _ in range(40)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(*x, 1, 2, 3, 4) for x in rows], "doc_id long, text string, lang string, part int, mask int, n int, id int")
    found = audit(docs, spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int, n int"))
    got = {(x["part"], x["filter_order"], x["step"]): [x[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for x in found.collect()}
    assert got == plain(rows, [x for x in labels if x[0] is not None])


def test_no_documents_give_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_least_squares_give_shapley_values(n):
    r, weights = random.Random(n), shapley_weights(n)
    value = [0, *(r.randrange(1000) for _ in range(2**n - 1))]
    for f in range(n):
        exact = sum((value[before | 1 << f] - value[before] for p in permutations(range(n)) for before in [sum(1 << g for g in p[: p.index(f)])]), Fraction(0)) / factorial(n)
        assert Fraction(sum(w * v for w, v in zip(weights[f], value, strict=True)), factorial(n)) == exact


def test_limits_of_the_conditions():
    assert mask_of(b" ".join(b"w%d" % k for k in range(99))) & 1 and not mask_of(b" ".join(b"w%d" % k for k in range(100))) & 1
    assert not mask_of(b" ".join([b"a", b"b", b"c", b"d", b"d"])) & 2 and mask_of(b"a a") & 2
    assert not mask_of(b"A" + b"b" * 9) & 4 and mask_of(b"A" + b"b" * 8) & 4
    assert mask_of("A".encode() + "é".encode() * 8) & 4 and not mask_of("A".encode() + "é".encode() * 9) & 4
    assert mask_of(b"a|") & 8 and not mask_of(b"a!") & 8
    assert filters.REPEATED == 16
