"""Versions of paths as numbered bits, against plain sets."""

import random

from pyspark.sql import functions as F

from filing_jobs.operators import audit
from filing_jobs.sources.io import Dict
from filing_jobs.store import stored


def dictionary(spark):
    known = [("a", "2020v1.0", "/R/A"), ("b", "2021v1.0", "/R/B"), ("b", "ö 🙂", "/R/B")]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return Dict(frame([("a",), ("b",)], "canonical_name string"), frame(known, "canonical_name string, version string, xpath string"), frame([("/R/A", "a"), ("/R/B", "b")], "xpath string, canonical_name string"))


def test_version_sets_equal_plain_sets(spark):
    r, d = random.Random(5), dictionary(spark)
    versions = ["", "2020v1.0", "2021v1.0", "ö 🙂", "x;y", " ", *(f"free {k}" for k in range(60))]
    filings = [(f"f{k:03}", r.choice(versions)) for k in range(300)]
    rows = [(f, v, x, 1, r.choice(["", f"s {f}"])) for f, v in filings for x in r.sample(["/R/A", "/R/B", "/R/C", "/R/D/E", "/R/never covered"], 3)]
    rows += [("f900", "", "/R/no version", 1, ""), ("f901", None, "/R/no version", 2, "")]
    heads = spark.createDataFrame([*filings, ("f900", ""), ("f901", None)], "path string, return_version string").repartition(3)
    paths = spark.createDataFrame(rows, "path string, return_version string, xpath string, n long, sample string").repartition(5)
    numbers = audit.version_numbers(heads, d)
    of = {x["version"]: x["missing"] for x in numbers.collect()}
    assert of == {v: v not in {"2020v1.0", "2021v1.0", "ö 🙂"} for _, v in filings if v}
    stats = audit.path_stats(paths, d, numbers)
    got = {x["xpath"]: x for x in audit.with_versions(stats, numbers).collect()}
    assert set(got) == {x[2] for x in rows}
    for xpath, found in got.items():
        own = [x for x in rows if x[2] == xpath]
        seen = {x[1] for x in own if x[1]}
        assert found["filing_count"] == len(own) and set(found["versions"]) == seen and len(found["versions"]) == len(seen)
        assert found["versions"] == sorted(seen, key=lambda v: v.encode()) and found["known"] == (xpath in ("/R/A", "/R/B"))
        assert found["version_covered"] == (not any(of[v] for v in seen))
        assert found["sample"] == min(((x[0], x[4]) for x in own if x[4]), default=("", ""))[1]
    assert got["/R/no version"]["versions"] == [] and got["/R/no version"]["version_covered"]
    unknown = {x["xpath"]: x for x in audit.unknown_paths(stats, d, numbers).collect()}
    assert set(unknown) == set(got) - {"/R/A", "/R/B"} and all(unknown[x]["versions"] == got[x]["versions"] for x in unknown)


def test_more_versions_than_a_bitmap_holds(spark):
    d, n = dictionary(spark), 70_001
    heads = spark.range(n).select(F.col("id").cast("string").alias("path"), F.format_string("free text %06d", "id").alias("return_version"))
    xpath = F.when(F.col("path").cast("long") % 3 == 0, "/R/third").otherwise("/R/rest")
    paths = heads.select("path", "return_version", xpath.alias("xpath"), F.lit(1).cast("long").alias("n"), F.lit("").alias("sample"))
    numbers = audit.version_numbers(heads, d)
    stats = {x["xpath"]: x for x in audit.path_stats(paths, d, numbers).collect()}
    for xpath, count in (("/R/third", 23334), ("/R/rest", n - 23334)):
        sets = stats[xpath]["version_sets"]
        assert sum(b.bit_count() for s in sets for b in s["bits"]) == stats[xpath]["filing_count"] == count
        assert len(sets) > 1 and all(len(s["bits"]) <= 4096 for s in sets)
    third = audit.with_versions(audit.path_stats(paths.where("xpath = '/R/third'"), d, numbers), numbers).first()
    assert third["versions"] == [f"free text {k:06}" for k in range(0, n, 3)] and not third["version_covered"]


def test_no_corpus_is_broadcast(spark, monkeypatch):
    """Paths of filings that Spark holds for few bytes: they are alike, compressed, and its estimate is from before they are inlined."""
    d = dictionary(spark)
    row = F.struct(F.lit("/R/A").alias("xpath"), F.lit(1).cast("long").alias("n"), F.lit("x").alias("sample"))
    held = stored(spark.range(20_000).select(F.col("id").cast("string").alias("path"), F.lit("2020v1.0").alias("return_version"), F.array(*[row] * 50).alias("paths")), "few-bytes")
    heads, paths = held.select("path", "return_version"), held.select("path", "return_version", F.inline("paths"))
    for most in (100_000, 0):
        monkeypatch.setattr(audit, "MANY", most)
        found = audit.field_frequency(paths, d, heads.agg(F.count("*").alias("n")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan and ("BroadcastHashJoin" in plan) == (most > 0)
        assert sorted(tuple(x) for x in found.collect()) == [("a", 20_000, 100.0, 20_000, 100.0), ("b", 0, 0.0, 0, 0.0)]
        numbers = audit.version_numbers(heads, d)
        named = audit.with_versions(stored(audit.path_stats(paths, d, numbers), "stats"), numbers)
        assert "BuildLeft" not in named._jdf.queryExecution().executedPlan().toString()
        assert [(x["xpath"], x["filing_count"], x["versions"]) for x in named.collect()] == [("/R/A", 1_000_000, ["2020v1.0"])]


def test_no_filings(spark):
    d = dictionary(spark)
    heads = spark.createDataFrame([], "path string, return_version string")
    paths = spark.createDataFrame([], "path string, return_version string, xpath string, n long, sample string")
    numbers = audit.version_numbers(heads, d)
    stats = audit.path_stats(paths, d, numbers)
    assert numbers.count() == stats.count() == audit.unknown_paths(stats, d, numbers).count() == 0
