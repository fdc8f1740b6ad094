"""Report tables. Each function builds a DataFrame; ``write_*`` puts it somewhere."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import confidence, form_title
from filing_jobs.operators.categories import tree
from filing_jobs.operators.dictionary import sorted_versions
from filing_jobs.sources.io import Dict


def versions_in_order(field_xpaths: DataFrame) -> list[str]:
    """All versions of a dictionary: tens."""
    return field_xpaths.agg(sorted_versions(F.collect_set("version")).alias("v")).first()["v"]


def current(fields: DataFrame) -> DataFrame:
    """Fields with their sorted versions and the path of the last one."""
    rows = fields.withColumn("versions", sorted_versions(F.map_keys("xpaths")))
    return rows.withColumn("xpath", F.coalesce(F.col("xpaths")[F.element_at("versions", -1)], F.lit("")))


def dictionary_table(fields: DataFrame, versions: list[str]) -> DataFrame:
    """SNK-1. One row per field, one column per version with its path."""
    rows = current(fields)
    names = [F.coalesce(F.col("xpaths")[v], F.lit("")).alias(f"xpath_{v}") for v in versions]
    return rows.select("canonical_name", "schedule", "xpath", F.col("label").alias("human_label"), F.col("type").alias("data_type"), F.col("raw_type").alias("raw_xsd_type"), F.col("group").alias("parent_group"), F.col("repeating").alias("is_repeating"), "description", "version_start", "version_end", F.array_join("versions", ";").alias("versions"), *names)


def lookup_document(d: Dict) -> DataFrame:
    """SNK-2. The dictionary as one JSON document: metadata, fields, path index. Dictionary-sized."""
    entry = F.struct("schedule", "label", "type", "raw_type", "description", "group", "repeating", "xpaths", "version_start", "version_end")
    fields = d.fields.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical_name", F.to_json(entry).alias("e"))))).alias("m"), F.count("*").alias("n"))
    index = d.xpath_index.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("xpath", "canonical_name")))).alias("i"))
    versions = d.field_xpaths.agg(sorted_versions(F.collect_set("version")).alias("v"))
    body = F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"])), ",")
    meta = F.to_json(F.struct(F.col("v").alias("versions"), F.col("n").alias("total_fields")))
    one = fields.crossJoin(F.broadcast(index)).crossJoin(F.broadcast(versions))
    return one.select(F.concat(F.lit('{"metadata":'), meta, F.lit(',"fields":{'), body, F.lit('},"xpath_index":'), F.to_json("i"), F.lit("}")).alias("value"))


def quoted(text: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")


def reference_entries(fields: DataFrame) -> DataFrame:
    """SNK-3. (schedule, section, canonical_name, markdown): fields outside groups first, then group by group."""
    rows = current(fields)
    line = lambda name, value: F.concat(F.lit(f"| **{name}** | "), value, F.lit(" |"))
    code = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    changed = F.size(F.array_distinct(F.map_values("xpaths"))) > 1
    text = F.concat_ws(
        "\n", F.concat(F.lit("#### "), "label"), F.lit(""), F.lit("| Property | Value |"), F.lit("|----------|-------|"), line("Canonical Name", code(F.col("canonical_name"))), line("Data Type", F.col("type")),
        F.when(F.col("description") != "", line("Description", F.col("description"))), line("First Version", F.col("version_start")), line("Latest Version", F.col("version_end")), line("All Versions", F.array_join("versions", ", ")),
        F.when(F.col("group") != "", line("Repeating Group", code(F.col("group")))), F.when(F.col("xpath") != "", line("XPath", code(F.col("xpath")))), F.when(changed, line("Note", F.lit("XPath changed across versions"))),
    )
    return rows.select("schedule", form_title(F.col("schedule")).alias("title"), F.col("group").alias("section"), "canonical_name", text.alias("markdown")).orderBy("schedule", "section", "canonical_name")


def spec_reference(specs: DataFrame) -> DataFrame:
    """SNK-5. What an extraction holds and where: 12 columns, lists joined by "; "."""
    many = lambda c: F.array_join(c, "; ")
    file = F.when(F.col("group_name") == "", "scalar_fields").otherwise(F.concat(F.lit("group_"), "group_name"))
    return specs.select("field_name", "label", "schedule", "type", "description", F.coalesce(F.col("frequency_pct").cast("string"), F.lit("")).alias("frequency_pct"), "priority", "relevance", many("categories").alias("categories"), many("sources").alias("source_files"), file.alias("output_file"), "sample_xpath")


def unknown_report(unknown: DataFrame, matches: DataFrame, n_filings: DataFrame) -> DataFrame:
    """SNK-6. Unknown paths, the most frequent first, with their share of filings and probable match."""
    rows = unknown.join(matches, "xpath", "left").crossJoin(F.broadcast(n_filings.select(F.col("n").alias("n_filings"))))
    return rows.select(
        "xpath", "element_name", "schedule", "parent_xpath", "filing_count", (F.col("filing_count") * 100.0 / F.col("n_filings")).alias("pct_of_filings"), F.array_join("versions", ";").alias("versions_seen"), "version_covered",
        "data_type_guess", F.substring("sample_value", 1, 100).alias("sample_value"), F.coalesce("match", F.lit("")).alias("fuzzy_match"), F.coalesce("score", F.lit(0.0)).alias("fuzzy_score"), F.coalesce("reason", F.lit("")).alias("fuzzy_reason"),
    ).orderBy(F.desc("filing_count"), "schedule", "xpath")


def gaps(unknown: DataFrame, n: int = 30) -> DataFrame:
    """SNK-7. The most frequent unknown paths in covered versions."""
    return unknown.where("version_covered").orderBy(F.desc("filing_count"), "xpath").limit(n)


def renames(matches: DataFrame, n: int = 30) -> DataFrame:
    """SNK-7. The best matches with their band."""
    return matches.withColumn("confidence", confidence(F.col("score"))).orderBy(F.desc("score"), "xpath").limit(n)


#: The report's parts in their order, with their headings.
PARTS = {"summary": "Summary", "warnings": "Warnings", "versions": "Schema versions", "schedules": "Schedules", "matches": "Probable renames", "gaps": "Gaps in covered versions", "uncovered": "Unknown paths of missing versions", "unused": "Fields that no filing has"}
COUNTS = ["filings_audited", "unique_xpaths_seen", "matched_xpaths", "unknown_xpaths", "unknowns_version_covered", "unknowns_version_missing", "fuzzy_matched", "unused_fields", "missing_versions"]


def audit_report(found: NamedTuple, d: Dict, n: int = 30) -> DataFrame:
    """SNK-7. (part, ord, subject, detail): the audit as one document, at most ``n`` lines of each part and how many more there are.

    ``found`` is what ``workloads.audit_corpus`` gives; all that it counts is there whole, as tables.
    """
    matched = found.matches.select("xpath", F.substring_index("match", "/", -1).alias("leaf"))
    unknown = found.unknown.join(matched, "xpath", "left").withColumn("leaf", F.coalesce("leaf", F.lit("-")))
    known = d.field_xpaths.select("version").distinct().withColumn("d", F.lit(True))
    seen = found.versions.where("version != ''").select("version", F.lit(True).alias("s"))
    where = F.when(F.col("d").isNull(), "only in filings").when(F.col("s").isNull(), "only in the dictionary").otherwise("in both")
    low = F.when(F.expr("coverage_pct < 50 and total_xpaths > 5"), ", low").otherwise("")
    counts = found.summary.select(F.posexplode(F.array(*(F.struct(F.lit(c).alias("subject"), F.col(c).cast("string").alias("detail")) for c in COUNTS)))).select("pos", "col.*")
    parts = {
        "summary": (counts, ["pos"], F.col("subject"), F.col("detail")),
        "warnings": (found.warnings, ["kind", "subject"], F.concat_ws(" ", "kind", F.nullif("subject", F.lit(""))), F.col("message")),
        "versions": (known.join(seen, "version", "full"), ["version"], F.col("version"), where),
        "schedules": (found.schedules, ["schedule"], F.col("schedule"), F.concat(F.format_string("%d of %d paths are known", "matched", "total_xpaths"), low)),
        "matches": (renames(found.matches, n), [F.desc("score"), "xpath"], F.col("xpath"), F.concat("confidence", F.lit(" "), "match", F.lit(": "), "reason")),
        "gaps": (gaps(unknown, n), [F.desc("filing_count"), "xpath"], F.col("xpath"), F.concat_ws(", ", F.format_string("%d filings", "filing_count"), "data_type_guess", "leaf")),
        "uncovered": (unknown.where("not version_covered"), [F.desc("filing_count"), "xpath"], F.col("xpath"), F.concat_ws(", ", F.format_string("%d filings", "filing_count"), F.array_join("versions", " "), "leaf")),
        "unused": (found.unused, ["canonical_name"], F.col("canonical_name"), F.lit("")),
    }
    whole = {"matches": found.matches, "gaps": unknown.where("version_covered")}
    out = None
    for name, (rows, order, subject, detail) in parts.items():
        first = rows.orderBy(*order).limit(n).withColumn("ord", F.row_number().over(Window.orderBy(*order)))  # at most n rows
        first = first.select(F.lit(name).alias("part"), "ord", subject.alias("subject"), detail.alias("detail"))
        rest = whole.get(name, rows).agg(F.count("*").alias("n")).where(F.col("n") > n)
        first = first.unionByName(rest.select(F.lit(name).alias("part"), F.lit(n + 1).alias("ord"), F.lit("").alias("subject"), F.format_string("and %d more", F.col("n") - n).alias("detail")))
        out = first if out is None else out.unionByName(first)
    return out


def report_text(report: DataFrame) -> DataFrame:
    """SNK-7. (value): the report's lines under their headings, in order; at most n + 3 lines of each part, so one task sorts them."""
    place = F.array_position(F.lit(list(PARTS)), F.col("part"))
    line = F.when(F.col("subject") == "", F.col("detail")).otherwise(F.concat_ws(": ", F.concat(F.lit("`"), "subject", F.lit("`")), F.nullif("detail", F.lit(""))))
    lines = report.select(place.alias("place"), "ord", F.concat(F.lit("- "), line).alias("value"))
    heads = report.select("part").distinct().select(place.alias("place"), F.lit(0).alias("ord"), F.concat(F.lit("\n## "), F.element_at(F.lit(list(PARTS.values())), place.cast("int")), F.lit("\n")).alias("value"))
    return lines.unionByName(heads).coalesce(1).sortWithinPartitions("place", "ord").select("value")


def selection_export(selected: DataFrame, fields: DataFrame, categories: DataFrame, frequency: DataFrame) -> DataFrame:
    """SNK-10. Chosen fields with all that is known of them; the sample path is that of the greatest version string."""
    about = fields.select(F.col("canonical_name").alias("field_name"), "label", "schedule", "type", "description", "xpaths")
    paths = F.array_join(F.transform("paths", lambda p: F.array_join(p, " > ")), " | ")
    rows = selected.join(about, "field_name").join(categories.select(F.col("canonical_name").alias("field_name"), paths.alias("categories")), "field_name", "left")
    rows = rows.join(frequency.select(F.col("canonical_name").alias("field_name"), F.col("present_pct").alias("frequency_pct")), "field_name", "left")
    sample = F.coalesce(F.col("xpaths")[F.array_max(F.map_keys("xpaths"))], F.lit(""))
    return rows.select("field_name", "label", "schedule", "type", "description", "frequency_pct", "priority", "relevance", F.coalesce("categories", F.lit("")).alias("categories"), sample.alias("sample_xpath"), "xpaths")


def missing_report(classified: DataFrame) -> DataFrame:
    """SNK-11. Missing elements in order of name."""
    return classified.where("found = 'missing'").select(F.col("name").alias("element_name"), "file", "line", "pattern", "context", "schedule").orderBy("element_name")


def write_tables(out: str, scalars: DataFrame, groups: dict[str, DataFrame], format: str = "parquet") -> None:
    """SNK-4. The scalar table and one directory per group."""
    for name, df in {"scalar_fields": scalars, **{f"group_{g}": t for g, t in groups.items()}}.items():
        df.write.mode("overwrite").options(**({"header": True} if format == "csv" else {})).format(format).save(f"{out}/{name}")


def write_table(df: DataFrame, out: str, format: str = "parquet") -> None:
    """SNK-1, 2, 3, 6 to 11. Any report: parquet, json, csv with a header, or text of its last column."""
    if format == "text":
        df.select(F.col(df.columns[-1]).alias("value")).write.mode("overwrite").text(out)
        return
    flat = df
    if format == "csv":
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
        flat = df.withColumns({c: F.to_json(c) for c in nested})
    flat.write.mode("overwrite").options(**({"header": True} if format == "csv" else {})).format(format).save(out)


def write_categories(labels: DataFrame, out: str) -> None:
    """SNK-9. JSON lines: the category paths of fields, one small object per field, and the tree, one per node."""
    labels.select("canonical_name", "paths").write.mode("overwrite").json(f"{out}/fields")
    tree(labels).write.mode("overwrite").json(f"{out}/tree")
