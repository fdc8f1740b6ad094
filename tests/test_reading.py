"""Reading filings: packed partitions, headers by Spark's own reader, versions resolved."""

import random

import pytest
from pyspark.sql import functions as F
from test_filings import DOCS, table

from filing_jobs.operators.resolve import resolve_paths
from filing_jobs.sources import io, shred


def plain_fit(sizes):
    """(size, bin) file by file: the first bin with room takes it."""
    bins, out = [], []
    for s in sorted(sizes, reverse=True):
        k = next((i for i, b in enumerate(bins) if b + s <= io.UNITS), len(bins))
        bins[k:] = bins[k:] or [0]
        bins[k] += s
        out.append((s, k))
    return out


def test_first_fit_of_equal_sizes_at_once_equals_file_by_file():
    r = random.Random(1)
    for _ in range(800):
        top = r.choice([5, 100, 600, 1024])
        sizes = [r.choice([r.randint(1, top), r.choice([1, 7, 300, 512, 513, 1024]), 3]) for _ in range(r.randint(0, 60))]
        classes = {s: sizes.count(s) for s in sizes}
        found = [(size, b + (k - a) // each) for size, a, z, b, each in io.first_fit(sorted(classes.items(), reverse=True)) for k in range(a, z + 1)]
        assert found == plain_fit(sizes)


@pytest.mark.parametrize("parts", [1, 7])
def test_packed_files_keep_the_bound(spark, parts):
    r = random.Random(2)
    rows = [(f"f{k:04d}", r.choice([0, 1, 100, r.randint(0, 5000), 4096, 20_000])) for k in range(500)]
    got = io.pack_files(spark.createDataFrame(rows, "path string, length long").repartition(parts), 8192).collect()
    assert sorted((x["path"], x["length"]) for x in got) == rows
    units = lambda n: min(io.UNITS, max(1, -(-n // 8)))
    want = dict(zip([p for _, p in sorted((-units(n), p) for p, n in rows)], [k for _, k in plain_fit([units(n) for _, n in rows])], strict=True))
    assert {x["path"]: x["bin"] for x in got} == want
    for k in set(want.values()):
        held = [x["length"] for x in got if x["bin"] == k]
        assert sum(held) <= 8192 or len(held) == 1
    assert io.pack_files(spark.createDataFrame([], "path string, length long"), 10).collect() == []


def test_packed_reading_has_a_partition_for_each_bin(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"{k:02d}.xml").write_text("<Return>" + "x" * (k * 40) + "</Return>")
    files = io.read_packed(spark, str(tmp_path), most_bytes=4096)
    sizes = files.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("content")).alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(x["n"] for x in sizes) == 30 and max(x["bytes"] for x in sizes) <= 4096 and len(sizes) <= 8
    assert io.listing(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(x["bytes"] for x in sizes)


def test_headers_by_schema_equal_headers(spark):
    filings = table(spark)
    both = [{r["path"]: r for r in f(filings).collect()} for f in (shred.headers, shred.headers_by_schema)]
    assert both[0].keys() == both[1].keys() == {*DOCS, "z.xml"} and both[0] == both[1]


def plain_resolve(own, asked):
    """The rules one after the other."""
    def key(v):
        import re

        m = re.match(r"(\d{4})v(\d+)\.(\d+)", v)
        return (int(m[1]), int(m[2]) * 10 + int(m[3])) if m else (0, 0)

    for rule, fits in enumerate((lambda v: v == asked, lambda v: key(v)[0] == key(asked)[0], lambda v: key(v) < key(asked), lambda v: True), 1):
        found = [v for v in own if fits(v)]
        if found:
            best = max(found, key=lambda v: (key(v), v))
            return own[best], rule
    return None


def test_versions_resolve_as_rule_by_rule(spark):
    r = random.Random(5)
    versions = [f"{y}v{a}.{b}" for y in range(2015, 2022) for a in (1, 4, 5) for b in (0, 10)] + ["odd", "2020", ""]
    fields = {f"f{k}": {v: f"/x/{k}/{v}" for v in r.sample(versions, r.randint(1, 6))} for k in range(40)}
    asked = r.sample(versions, 20) + ["2019v9.9", "1900v1.0", "2100v1.0", "junk", "junk two", None, "2019v9.9"]
    rows = [(f, v, x) for f, own in fields.items() for v, x in own.items()]
    found = resolve_paths(spark.createDataFrame(rows, "canonical_name string, version string, xpath string"), spark.createDataFrame([(v,) for v in asked], "version string"))
    got = {(x["field"], x["version"]): (x["xpath"], x["rule"]) for x in found.collect()}
    assert got == {(f, v or ""): plain_resolve(own, v or "") for f, own in fields.items() for v in asked}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert resolve_paths(spark.createDataFrame(rows, "canonical_name string, version string, xpath string"), spark.createDataFrame([], "version string")).collect() == []
