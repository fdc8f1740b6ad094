"""Times the headline queries once each, after a warm-up, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import SparkSession  # noqa: E402

from filing_jobs import queries as own  # noqa: E402
from filing_jobs.plans import workloads  # noqa: E402
from filing_jobs.sources import samples  # noqa: E402

HEADLINE = ["src_headers", "src_elements", "ext_scalars", "ext_groups", "aud_path_stats", "aud_frequency", "dic_fields", "fuz_parts", "snk_dictionary", "xsd_elements"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = "/root/testdata/sf0.001"
    own.src_status(spark, small if os.path.isdir(small) else sf_dir).collect()
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    queries = own.queries()
    for name in HEADLINE:
        timed(name, lambda name=name: sink(queries[name](spark, sf_dir)))
    # the workloads on filings that are stored already, as they would be
    from filing_jobs.store import stored

    filings = stored(samples.filings(spark, sf_dir), "bench-filings")
    n = filings.count()

    def extraction() -> None:
        scalars, groups = workloads.extract_tables(filings, own.sample_specs(spark))
        for df in (scalars, *groups.values()):
            sink(df)

    def auditing() -> None:
        found = workloads.audit_corpus(filings, samples.dictionary(spark))
        for df in (found.summary, found.frequency, found.unknown, found.warnings):
            sink(df)

    timed("w1_extract_tables", extraction)
    timed("w2_audit", auditing)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rpartition("sf")[2], "filings": n, "filings_per_second_w1": round(n / seconds["w1_extract_tables"], 1), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
