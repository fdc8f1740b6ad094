"""Similarity joins and category joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import bigrams
from filing_jobs.operators import fuzzy, select
from filing_jobs.operators.fuzzy import alike, holding, tokens


def pairs_of(name):
    low = name.lower()
    return {low[k : k + 2] for k in range(len(low) - 1)}


def random_names(r, n):
    words = ["Total", "Revenue", "Amt", "Cd", "Grp", "Expns", "Pay", "x", "", "Officer", "Txt", "A"]
    names = ["".join(r.choice(words) for _ in range(r.randint(0, 5))) for _ in range(n)]
    return [*names, *("".join(r.choice("abAB") for _ in range(r.randint(0, 9))) for _ in range(n // 2))]


@pytest.mark.parametrize("least", [(3, 5), (3, 10)])
def test_similar_names_equal_all_pairs(spark, least):
    r, (a, b) = random.Random(4), least
    left, right = ([(r.choice(["k", "l", None]), n) for n in random_names(r, 120)] for _ in range(2))
    frame = lambda rows: spark.createDataFrame(list(dict.fromkeys(rows)), "k string, name string")
    known = tokens(frame(left).union(frame(right)).select("name"))
    got = {(x["k"], x["left"], x["right"]): (x["both"], x["n"], x["m"]) for x in alike(frame(left), frame(right), ["k"], least, known).collect()}
    want = {}
    for k, x in set(left):
        for q, y in set(right):
            p, s = pairs_of(x), pairs_of(y)
            if k is not None and k == q and p and s and 2 * b * len(p & s) >= a * (len(p) + len(s)):
                want[k, x, y] = (len(p & s), len(p), len(s))
    assert got == want and len(got) > 50


@pytest.mark.parametrize("sizes", [(100_000, 50_000), (30, 20)])
def test_names_that_hold_others_equal_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(fuzzy, "TEXTS", sizes[0])
    monkeypatch.setattr(fuzzy, "PARTS", sizes[1])
    r = random.Random(7)
    texts, parts = ({n.lower() for n in random_names(r, 150) if len(n) > 2} | {"é🙂x", "same"} for _ in range(2))
    frame = lambda names: spark.createDataFrame([(n,) for n in sorted(names)], "name string").repartition(3)
    got = sorted(map(tuple, holding(frame(texts), frame(parts)).collect()))
    assert got == sorted((t, p) for t in texts for p in parts if p in t or t in p)
    assert holding(frame(texts), frame(set())).collect() == holding(frame(set()), frame(parts)).collect() == []


def test_rare_pairs_meet_far_less_often(spark):
    r = random.Random(1)
    stems = ["".join(r.choice("bcdfgklmnprstv") + r.choice("aeiou") for _ in range(r.randint(3, 6))).title() for _ in range(80)]
    names = list(dict.fromkeys("".join(r.sample(stems, 2)) + "Amt" for _ in range(1500)))
    rows = spark.createDataFrame([("k", n) for n in names], "k string, name string")
    both = [rows.select("k", F.col("name").alias(c), F.explode(bigrams(F.col("name"))).alias("pair")) for c in ("left", "right")]
    plain = both[0].join(both[1], ["k", "pair"]).count()
    found = alike(rows, rows, ["k"], (3, 5), tokens(rows.select("name")))
    found.collect()
    met = max(joined_rows(found._jdf.queryExecution().executedPlan()))
    assert met * 10 < plain, (met, plain)


def joined_rows(node):
    """Rows out of each join of an executed plan."""
    name = node.nodeName()
    inner = [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [node.plan()] if "QueryStage" in name else []
    children = node.children()
    out = [node.metrics().apply("numOutputRows").value()] if "Join" in name else []
    for child in inner + [children.apply(i) for i in range(children.size())]:
        out += joined_rows(child)
    return out


def test_categories_meet_as_text_does(spark):
    r = random.Random(9)
    path = lambda: [r.choice("ABC") + r.choice(["", "1", "x"]) for _ in range(r.randint(0, 3))]
    labels = [(f"f{k}", [path() for _ in range(r.randint(0, 3))]) for k in range(80)] + [("null", None)]
    chosen = sorted({" > ".join(path()) for _ in range(12)} - {""})
    fields = spark.createDataFrame([(n, r.choice(["S", "T"])) for n, _ in labels], "canonical_name string, schedule string")
    categories = spark.createDataFrame(labels, "canonical_name string, paths array<array<string>>")
    meets = lambda p, c: p == c or p.startswith(c + " > ") or c.startswith(p + " > ")
    want = {n for n, paths in labels if any(meets(" > ".join(p), c) for p in paths or [] for c in chosen)}
    scheduled = {x["canonical_name"] for x in fields.where("schedule = 'S'").collect()}
    for schedules, picked in ((["S"], chosen), (spark.createDataFrame([("S",), ("S",), (None,)], "s string"), spark.createDataFrame([(c,) for c in chosen * 2], "c string"))):
        got = [x["canonical_name"] for x in select.candidates(fields, categories, schedules, picked).collect()]
        assert sorted(got) == sorted(want | scheduled)
    assert select.candidates(fields, categories, [], []).count() == 0
