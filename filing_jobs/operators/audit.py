"""Auditing a dictionary against a corpus: coverage, unknown and unused paths, frequencies, proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import canonical_name, guessed_type, leaf_of, nontrivial, parent_of, rename_status, schedule_of, segments
from filing_jobs.sources.io import Dict, versions_of
from filing_jobs.sources.shred import path_counts
from filing_jobs.store import stored

SAMPLE = 100
#: Rows of a table that is broadcast to a corpus's paths or versions.
MANY = 100_000


def beside(table: DataFrame) -> DataFrame:
    """A table to join to a corpus: broadcast if it has at most MANY rows, else merged.

    Spark is told either way. It takes the size of the corpus's rows from compressed files before their arrays are
    exploded, far too low, and would broadcast those through the driver.
    """
    return F.broadcast(table) if table.count() <= MANY else table.hint("merge")


def digests(filings: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """AUD-1. Header rows, and the rows of ``filing_paths``, of one stored pass: a filing lies whole in one row, so nothing is shuffled."""
    rows = stored(path_counts(filings, SAMPLE, **columns), "filing-digests")
    return rows.drop("paths"), rows.select("path", "return_version", F.inline("paths"))


def filing_paths(elements: DataFrame) -> DataFrame:
    """AUD-1. (path, return_version, xpath, n, sample, sample_ord) per filing and path; the first text that is not empty, cut to 100 characters."""
    said = F.col("text") != ""
    return elements.groupBy("path", "return_version", "xpath").agg(F.count("*").alias("n"), F.coalesce(F.substring(F.min_by("text", F.when(said, F.col("doc_ord"))), 1, SAMPLE), F.lit("")).alias("sample"))


def filing_counts(paths: DataFrame) -> DataFrame:
    """AUD-1. (path, elements, distinct_xpaths) per filing."""
    return paths.groupBy("path").agg(F.sum("n").alias("elements"), F.count("*").alias("distinct_xpaths"))


def version_numbers(headers: DataFrame, d: Dict) -> DataFrame:
    """AUD-2, AUD-8. (version, missing, number): the versions of filings that are not empty, whether the dictionary lacks them, and their numbers in order.

    A filer's version is free text, so there may be very many: each task numbers its own range of them, from
    a multiple of 2^33 on. Stored, so that the numbers stay.
    """
    seen = headers.where("return_version != ''").select(F.col("return_version").alias("version")).distinct()
    flagged = seen.join(versions_of(d).distinct().withColumn("has", F.lit(True)), "version", "left")
    return stored(flagged.select("version", F.col("has").isNull().alias("missing")).sort("version").withColumn("number", F.monotonically_increasing_id() + 1), "version-numbers")


def path_stats(paths: DataFrame, d: Dict, numbers: DataFrame) -> DataFrame:
    """AUD-2. (xpath, filing_count, version_sets, version_covered, sample, known) over the corpus.

    The sample is the first one in order of filings; empty versions don't count. Counted per path and version
    before anything is shuffled; a path's versions are then bits at their ``numbers``, one bitmap (bucket, bits)
    for each 32768 of them, cut behind its last bit. A path is covered unless the dictionary lacks one of its versions.
    """
    each = paths.groupBy("xpath", F.col("return_version").alias("version")).agg(F.count("*").alias("n"), F.min(F.when(F.col("sample") != "", F.struct("path", "sample"))).alias("first"))
    bit = F.bitmap_bit_position("number")
    sets = each.join(beside(numbers), "version", "left").groupBy("xpath", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        F.bool_or("missing").alias("missing"),
        F.substring(F.bitmap_construct_agg(bit), F.lit(1), F.floor(F.max(bit) / 8).cast("int") + 1).alias("bits"),
    )
    seen = sets.groupBy("xpath").agg(
        F.sum("n").alias("filing_count"),
        F.array_sort(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "bits")))).alias("version_sets"),
        (~F.coalesce(F.bool_or("missing"), F.lit(False))).alias("version_covered"),
        F.coalesce(F.min("first")["sample"], F.lit("")).alias("sample"),
    )
    known = d.xpath_index.select("xpath").distinct().withColumn("known", F.lit(True))
    return seen.join(known, "xpath", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def with_versions(stats: DataFrame, numbers: DataFrame) -> DataFrame:
    """AUD-2. ``version_sets`` as ``versions``, the sorted names, for rows that are shown: only then a row holds all its names."""
    byte = "cast(conv(hex(substring(s.bits, cast(p div 8 as int) + 1, 1)), 16, 10) as int)"
    of = F.expr(f"flatten(transform(version_sets, s -> transform(filter(sequence(0, 8 * length(s.bits) - 1), p -> (shiftright({byte}, p % 8) & 1) = 1), p -> (s.bucket - 1) * 32768 + p + 1)))")
    names = stats.select("xpath", F.explode(of).alias("number")).join(beside(numbers), "number").groupBy("xpath").agg(F.array_sort(F.collect_list("version")).alias("versions"))
    none = F.array().cast("array<string>")
    return stats.drop("version_sets").join(names, "xpath", "left").withColumn("versions", F.coalesce("versions", none))


def normalised(paths: DataFrame, d: Dict) -> DataFrame:
    """AUD-3. The rows whose path is in the dictionary, with the stable field name."""
    return paths.join(beside(d.xpath_index), "xpath")


def field_frequency(paths: DataFrame, d: Dict, n_filings: DataFrame) -> DataFrame:
    """AUD-4, SNK-8. Present and nontrivial filings of every dictionary field, in numbers and percent of ``n_filings`` (one row, column n).

    All audited filings count, malformed ones too. A field has a nontrivial value in a filing if any of
    its paths has one.
    """
    each = normalised(paths, d).groupBy("path", "canonical_name").agg(F.bool_or(nontrivial(F.col("sample"))).alias("nontrivial"))
    found = each.groupBy("canonical_name").agg(F.count("*").alias("present_count"), F.count_if("nontrivial").alias("nontrivial_count"))
    every = d.fields.select("canonical_name").join(found, "canonical_name", "left").crossJoin(F.broadcast(n_filings.select(F.col("n").alias("n_filings"))))
    share = lambda c: F.when(F.col("n_filings") > 0, F.coalesce(c, F.lit(0)) * 100.0 / F.col("n_filings")).otherwise(0.0)
    return every.select("canonical_name", F.coalesce("present_count", F.lit(0)).alias("present_count"), share(F.col("present_count")).alias("present_pct"), F.coalesce("nontrivial_count", F.lit(0)).alias("nontrivial_count"), share(F.col("nontrivial_count")).alias("nontrivial_pct"))


def drop_form_roots(unknown: DataFrame) -> DataFrame:
    """AUD-6. Without paths that are a form alone."""
    one = F.size(segments(F.col("xpath"))) == 1
    return unknown.where(~(one & (schedule_of(F.col("xpath")).startswith("IRS") | (schedule_of(F.col("xpath")) == "ReturnHeader"))))


def drop_containers(unknown: DataFrame, d: Dict) -> DataFrame:
    """AUD-7. Without empty paths above a dictionary path: an anti-join with all proper prefixes."""
    parts = F.split("xpath", "/")
    prefixes = d.xpath_index.select(F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"), "xpath")
    prefixes = prefixes.where("above != xpath").select("above").distinct()
    return unknown.join(prefixes, (F.col("xpath") == F.col("above")) & (F.col("sample") == ""), "left_anti")


def filing_versions(headers: DataFrame) -> DataFrame:
    """AUD-8. (version, filings): the versions that filings have; "" where there is none."""
    return headers.groupBy(F.col("return_version").alias("version")).agg(F.count("*").alias("filings"))


def missing_versions(headers: DataFrame, d: Dict) -> DataFrame:
    """AUD-8. The versions of filings that the dictionary lacks."""
    return headers.where("return_version != ''").select(F.col("return_version").alias("version")).distinct().join(versions_of(d), "version", "left_anti")


def unknown_paths(stats: DataFrame, d: Dict, numbers: DataFrame) -> DataFrame:
    """AUD-5, 6, 7, 9. Unknown paths with their parts, guessed type and whether all their versions are covered."""
    rows = with_versions(drop_containers(drop_form_roots(stats.where("not known")), d), numbers)
    x = F.col("xpath")
    return rows.select(
        "xpath", leaf_of(x).alias("element_name"), schedule_of(x).alias("schedule"), parent_of(x).alias("parent_xpath"), "filing_count", "versions",
        "version_covered", guessed_type(F.col("sample")).alias("data_type_guess"), F.col("sample").alias("sample_value"),
    )


def unused_fields(paths: DataFrame, d: Dict) -> DataFrame:
    """AUD-10. The dictionary's fields that no filing has."""
    return d.fields.select("canonical_name").join(normalised(paths.select("xpath").distinct(), d).select("canonical_name").distinct(), "canonical_name", "left_anti")


def coverage(stats: DataFrame, unknown: DataFrame) -> DataFrame:
    """AUD-11. One row: matched and unknown paths, and the matched ones in percent of both (0 if there are none)."""
    counts = stats.agg(F.count_if("known").alias("matched"), F.count("*").alias("seen")).crossJoin(unknown.agg(F.count("*").alias("unknown")))
    total = F.col("matched") + F.col("unknown")
    return counts.select("seen", "matched", "unknown", F.when(total > 0, F.col("matched") * 100.0 / total).otherwise(0.0).alias("coverage_pct"))


def schedule_coverage(stats: DataFrame) -> DataFrame:
    """AUD-12. Per schedule: all paths, also form roots and containers."""
    rows = stats.groupBy(schedule_of(F.col("xpath")).alias("schedule")).agg(F.count("*").alias("total_xpaths"), F.count_if("known").alias("matched"))
    return rows.withColumn("unknown", F.col("total_xpaths") - F.col("matched")).withColumn("coverage_pct", F.col("matched") * 100.0 / F.col("total_xpaths"))


def warnings(missing: DataFrame, unknown: DataFrame, per_schedule: DataFrame, d: Dict, n_filings: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """AUD-13. (kind, subject, count, message) of what needs a look."""
    row = lambda kind, subject, count, message: [F.lit(kind).alias("kind"), subject.alias("subject"), count.cast("long").alias("count"), message.alias("message")]
    out = missing.select(*row("MISSING VERSION", F.col("version"), F.lit(1), F.format_string("Filings use schema version %s, which the dictionary lacks.", "version")))
    often = unknown.crossJoin(F.broadcast(n_filings.select(F.col("n").alias("n_filings")))).where("filing_count >= greatest(2, n_filings * 0.1)").agg(F.count("*").alias("n"), F.count_if("version_covered").alias("covered")).where("n > 0")
    out = out.unionByName(often.select(*row("HIGH-FREQUENCY UNKNOWNS", F.lit(""), F.col("n"), F.format_string("%d unknown paths occur in 10%% of the filings or more; %d of them in covered versions.", "n", "covered"))))
    if matches is not None:
        bands = matches.agg(F.count("*").alias("n"), F.count_if(F.expr("score >= 0.8")).alias("high"), F.count_if(F.expr("score >= 0.6 and score < 0.8")).alias("med"), F.count_if(F.expr("score < 0.6")).alias("low")).where("n > 0")
        out = out.unionByName(bands.select(*row("FUZZY MATCHES", F.lit(""), F.col("n"), F.format_string("%d unknown paths have probable matches: %d high, %d medium, %d low.", "n", "high", "med", "low"))))
    has = d.fields.select("schedule").distinct().withColumn("has", F.lit(True))
    poor = per_schedule.where("coverage_pct < 50 and total_xpaths > 5").join(has, "schedule", "left")
    kind = F.when(F.col("has").isNull(), "MISSING SCHEDULE").when(F.col("matched") == 0, "XPATH MISMATCH").otherwise("LOW COVERAGE")
    low = poor.withColumn("kind", kind).select("kind", F.col("schedule").alias("subject"), F.col("total_xpaths").alias("count"), F.format_string("%d of %d paths are in the dictionary.", "matched", "total_xpaths").alias("message"))
    return out.unionByName(low)


def proposals(unknown: DataFrame, matches: DataFrame | None = None, least: int = 2) -> DataFrame:
    """AUD-14. Additions to review: unknown paths of at least ``least`` filings, one per canonical name (the greatest path)."""
    rows = unknown.where(F.col("filing_count") >= least)
    if matches is None:
        rows = rows.withColumns({"match": F.lit(None).cast("string"), "score": F.lit(None).cast("double"), "reason": F.lit(None).cast("string")})
    else:
        rows = rows.join(matches, "xpath", "left")
    rows = rows.withColumn("canonical", canonical_name(F.col("xpath"))).withColumn("status", rename_status(F.col("match"), F.col("score")))
    columns = [c for c in rows.columns if c != "canonical"]
    return rows.groupBy("canonical").agg(F.max_by(F.struct(*columns), "xpath").alias("r")).select("canonical", "r.*")


def summary(headers: DataFrame, stats: DataFrame, unknown: DataFrame, unused: DataFrame, missing: DataFrame, matches: DataFrame) -> DataFrame:
    """SNK-7. The audit's counts as one row."""
    parts = [
        headers.agg(F.count("*").alias("filings_audited")),
        coverage(stats, unknown).select(F.col("seen").alias("unique_xpaths_seen"), F.col("matched").alias("matched_xpaths"), F.col("unknown").alias("unknown_xpaths"), "coverage_pct"),
        unknown.agg(F.count_if("version_covered").alias("unknowns_version_covered"), F.count_if(F.expr("not version_covered")).alias("unknowns_version_missing")),
        unused.agg(F.count("*").alias("unused_fields")),
        missing.agg(F.count("*").alias("missing_versions")),
        matches.agg(F.count("*").alias("fuzzy_matched")),
    ]
    out = parts[0]
    for part in parts[1:]:  # each is one row
        out = out.crossJoin(F.broadcast(part))
    return out
