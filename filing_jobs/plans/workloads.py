"""The three workloads end to end: extract tables, audit a dictionary, build a dictionary."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.operators import audit, dictionary, extract, fuzzy
from filing_jobs.sources import xsd
from filing_jobs.sources.io import Dict
from filing_jobs.store import stored


def extract_tables(filings: DataFrame, specs: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """W1. The scalar table and one table per group, of one pass over the filings. Only wanted texts leave the parser."""
    return extract.tables_of_filings(filings, specs)


class Audit(NamedTuple):
    """The tables of an audit."""

    summary: DataFrame
    stats: DataFrame
    unknown: DataFrame
    matches: DataFrame
    unused: DataFrame
    missing: DataFrame
    frequency: DataFrame
    schedules: DataFrame
    warnings: DataFrame
    proposals: DataFrame
    versions: DataFrame


def audit_corpus(filings: DataFrame, d: Dict) -> Audit:
    """W2. Elements are aggregated to paths per filing before anything is stored or shuffled."""
    heads, paths = audit.digests(filings)
    d = d._replace(xpath_index=stored(d.xpath_index, "xpath-index"))  # it is asked for in every step
    n = heads.agg(F.count("*").alias("n"))
    numbers = audit.version_numbers(heads, d)
    stats = stored(audit.path_stats(paths, d, numbers), "path-stats")
    missing = numbers.where("missing").select("version")
    unknown = stored(audit.unknown_paths(stats, d, numbers), "unknown-paths")
    unused = stored(audit.unused_fields(paths, d), "unused-fields")
    matches = stored(fuzzy.match_unknowns(unknown, d, unused), "matches")
    schedules = audit.schedule_coverage(stats)
    return Audit(audit.summary(heads, stats, unknown, unused, missing, matches), stats, unknown, matches, unused, missing, audit.field_frequency(paths, d, n), schedules, audit.warnings(missing, unknown, schedules, d, n, matches), audit.proposals(unknown, matches), audit.filing_versions(heads))


def build_dictionary(schema_files: DataFrame) -> Dict:
    """W3. From schema files (version, path, content) to the dictionary."""
    return dictionary.build(xsd.expand(xsd.items(schema_files)))
