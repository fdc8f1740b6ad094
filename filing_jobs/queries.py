"""The library's queries over the given tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_jobs.functions import scalars as fn
from filing_jobs.operators import audit, browse, categories, dictionary, extract, fuzzy, outputs, select, specs, validate
from filing_jobs.operators.resolve import resolve_paths
from filing_jobs.plans.workloads import Audit, audit_corpus, build_dictionary
from filing_jobs.sources import io, samples, shred, xsd
from filing_jobs.store import new_folder, stored

Query = Callable[[SparkSession, str], DataFrame]


def one_string(df: DataFrame) -> DataFrame:
    """Arrays of strings as joined text, so that results compare as plain columns."""
    arrays = [f.name for f in df.schema.fields if f.dataType.simpleString() == "array<string>"]
    return df.withColumns({c: F.array_join(c, ";") for c in arrays})


# --- sources


def src_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.headers(samples.filings(spark, sf_dir))


def src_headers_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.headers_by_schema(samples.filings(spark, sf_dir))


def src_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of their texts' bytes, dealt into read partitions of 64 KB."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = docs.select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("length"))
    return io.pack_files(files, 1 << 16).groupBy("bin").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def src_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.status_counts(src_headers(spark, sf_dir))


def src_first_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.headers(io.first_filings(samples.filings(spark, sf_dir), 500)).select("path", "status")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.shred_filings(samples.filings(spark, sf_dir))


def src_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements(spark, sf_dir).groupBy("xpath", "section", "in_root_ns").agg(F.count("*").alias("n"), F.count_distinct("path").alias("filings"), F.sum(F.length("text")).alias("characters"), F.sum(F.size("anc")).alias("depth"))


def src_forms_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_string(shred.forms_present(elements(spark, sf_dir)))


# --- extraction


def sample_specs(spark: SparkSession) -> DataFrame:
    d = samples.dictionary(spark)
    out = None
    for schedule in dict.fromkeys(s for _, s, *_ in samples.SAMPLE_FIELDS):
        own = specs.from_schedule(d, schedule)
        out = own if out is None else out.unionByName(own)
    return out


def ext_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = src_headers(spark, sf_dir).where("return_version != ''")
    return resolve_paths(samples.dictionary(spark).field_xpaths, heads.select(F.col("return_version").alias("version")))


def ext_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.scalars_of_filings(samples.filings(spark, sf_dir), sample_specs(spark))


def ext_scalars_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.scalars(src_headers(spark, sf_dir), elements(spark, sf_dir), sample_specs(spark))


def ext_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.tables_of_filings(samples.filings(spark, sf_dir), sample_specs(spark))[1]["ContractorCompensationGrp"]


def ext_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.group_counts(extract.group_values(src_headers(spark, sf_dir), elements(spark, sf_dir), sample_specs(spark)))


def ext_preset_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.preset(samples.filings(spark, sf_dir), "organisations")


def ext_preset_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.preset(samples.filings(spark, sf_dir), "officer_pay")


def ext_preset_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.preset(samples.question_filings(spark, sf_dir), "revenue_and_expenses").select("path", "ein", "revenue", "expenses")


def ext_preset_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.preset(samples.question_filings(spark, sf_dir), "public_support").select("path", "ein", "public_support")


def ext_preset_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.preset(samples.question_filings(spark, sf_dir), "net_assets").select("path", "ein", "net_assets")


def ext_officers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.officers(samples.question_filings(spark, sf_dir))


def ext_older_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each path of the sample dictionary and its older name occur in the filings."""
    known = extract.with_older_names(samples.dictionary(spark).field_xpaths.select("canonical_name", "xpath").distinct())
    return elements(spark, sf_dir).groupBy("xpath").agg(F.count("*").alias("n")).join(known, "xpath").select("canonical_name", "xpath", "n")


# --- dictionary from part schema elements


def part_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_dictionary(spark, sf_dir).fields


def part_dictionary(spark: SparkSession, sf_dir: str) -> io.Dict:
    return dictionary.build(samples.schema_elements(spark, sf_dir))


def part_frequency(spark: SparkSession, sf_dir: str, fields: DataFrame) -> DataFrame:
    last = outputs.current(fields).select("canonical_name", "xpath")
    return samples.frequency(spark, sf_dir).join(last, "xpath").drop("xpath")


def dic_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_string(dictionary.exact_fields(samples.schema_elements(spark, sf_dir)).drop("xpaths"))


def dic_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = dictionary.merge_renames(dictionary.exact_fields(samples.schema_elements(spark, sf_dir)))
    return one_string(merged.select("xpath", "versions", F.transform("versions", lambda v: F.col("xpaths")[v]).alias("paths")))


def dic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_fields(spark, sf_dir).drop("xpaths")


def dic_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_dictionary(spark, sf_dir).xpath_index


def dic_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older names: the index of the sample dictionary against the paths that filings have."""
    return elements(spark, sf_dir).join(F.broadcast(samples.dictionary(spark).xpath_index), "xpath").groupBy("canonical_name", "xpath").agg(F.count("*").alias("n"))


def dic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.counts(samples.schema_elements(spark, sf_dir), part_fields(spark, sf_dir))


# --- functions


def fn_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, x = samples.schema_elements(spark, sf_dir).select("xpath", "element_name", "xsd_type").distinct(), F.col("xpath")
    group = fn.group_of(x)
    return e.select(
        "xpath", "xsd_type", fn.canonical_name(x).alias("canonical"), fn.label(F.col("element_name")).alias("label"), fn.inferred_description(x, F.col("element_name")).alias("inferred"), fn.type_name(F.col("xsd_type")).alias("type"),
        fn.without_prefix(F.col("xsd_type")).alias("bare_type"), group["name"].alias("group_name"), group["prefix"].alias("group_prefix"), group["relative"].alias("relative"), fn.schedule_of(x).alias("schedule"),
        fn.leaf_of(x).alias("leaf"), fn.parent_of(x).alias("parent"), fn.plain_words(F.col("element_name")).alias("words"), fn.form_title(fn.schedule_of(x)).alias("title"),
    )


def fn_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples.schema_elements(spark, sf_dir).groupBy("version").agg(F.count("*").alias("n"))
    a, b = fn.version_key(F.col("version")), fn.filing_version_key(F.col("version"))
    return rows.select("version", "n", a["year"].alias("year"), a["major"].alias("major"), a["minor"].alias("minor"), b["year"].alias("filing_year"), b["part"].alias("filing_part"))


def fn_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    v = F.get(F.array(F.lit("x"), F.col("event_id").cast("string"), F.col("value").cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"), F.lit("-"), F.lpad(F.col("event_id").cast("string"), 7, "0")), F.col("event_type"), F.lit("0"), F.lit("n/a "), F.repeat("event_type", 12), F.lit("")), (F.col("event_id") % 10).cast("int"))
    rows = e.select(v.alias("v"), (F.col("event_id") % 110).cast("double").alias("pct"))
    return rows.groupBy(fn.guessed_type(F.col("v")).alias("guess"), fn.nontrivial(F.col("v")).alias("nontrivial"), fn.frequency_band(F.col("pct")).alias("band"), fn.confidence(F.col("pct") / 100).alias("confidence")).agg(F.count("*").alias("n"))


def fn_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of element names that are alike by 0.6 or more, that hold one another, or that end alike."""
    names = samples.schema_elements(spark, sf_dir).groupBy(F.col("element_name").alias("name")).agg(F.collect_set("schedule").alias("schedules"))
    names = stored(names.withColumn("low", F.lower("name")), "names")  # schedules: six
    side = lambda n, *columns: names.select(*(F.col(c).alias(f"{c}_{n}") for c in columns))
    one, long = names.select("name"), names.where(F.length("low") > 5).select(F.col("low").alias("name")).distinct()
    near = fuzzy.alike(one, one, [], (3, 5), stored(fuzzy.tokens(one), "name-tokens")).select(F.col("left").alias("a"), F.col("right").alias("b"))
    held = fuzzy.holding(long, long).join(side("a", "low", "name"), F.col("l") == F.col("low_a")).join(side("b", "low", "name"), F.col("r") == F.col("low_b")).select("name_a", "name_b")
    ends = side("a", "low", "name").join(side("b", "low", "name"), F.right("low_a", F.lit(8)) == F.right("low_b", F.lit(8))).select("name_a", "name_b")
    pairs = near.union(held).union(ends).distinct().join(side("a", "name", "schedules"), F.col("a") == F.col("name_a")).join(side("b", "name", "schedules"), F.col("b") == F.col("name_b"))
    return pairs.select("a", "b", fn.dice(F.col("a"), F.col("b")).alias("dice"), fn.part_score(F.col("a"), F.col("b"), F.arrays_overlap("schedules_a", "schedules_b")).alias("part")).where("dice >= 0.6 or part > 0")


# --- audit


def corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, io.Dict, DataFrame]:
    heads, paths = audit.digests(samples.filings(spark, sf_dir))
    return heads, paths, samples.dictionary(spark), heads.agg(F.count("*").alias("n"))


def unknowns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, io.Dict, DataFrame, DataFrame]:
    heads, paths, d, n = corpus(spark, sf_dir)
    numbers = audit.version_numbers(heads, d)
    stats = stored(audit.path_stats(paths, d, numbers), "path-stats")
    return audit.unknown_paths(stats, d, numbers), stats, d, n, audit.unused_fields(paths, d)


def aud_filing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the table of elements; the other audits take the paths that the shredder counts."""
    return audit.filing_counts(audit.filing_paths(elements(spark, sf_dir).select("path", "return_version", "xpath", "doc_ord", "text")))


def aud_path_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads, paths, d, _ = corpus(spark, sf_dir)
    numbers = audit.version_numbers(heads, d)
    return one_string(audit.with_versions(stored(audit.path_stats(paths, d, numbers), "path-stats"), numbers).drop("version_covered"))


def aud_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, paths, d, n = corpus(spark, sf_dir)
    return audit.field_frequency(paths, d, n)


def aud_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_string(unknowns(spark, sf_dir)[0])


def aud_missing_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing_versions(src_headers(spark, sf_dir), samples.dictionary(spark))


def aud_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknowns(spark, sf_dir)[4]


def aud_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown, stats, *_ = unknowns(spark, sf_dir)
    return audit.coverage(stats, unknown)


def aud_schedule_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.schedule_coverage(unknowns(spark, sf_dir)[1])


def audited(spark: SparkSession, sf_dir: str) -> Audit:
    return audit_corpus(samples.filings(spark, sf_dir), samples.dictionary(spark))


def aud_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).warnings.drop("message")


def aud_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown, _, d, _, unused = unknowns(spark, sf_dir)
    return audit.proposals(unknown, fuzzy.match_unknowns(unknown, d, unused)).select("canonical", "xpath", "filing_count", "match", "score", "status")


def aud_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).summary


def snk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's report, its text written and read back; the lines of its parts."""
    d, out = samples.dictionary(spark), new_folder(spark, "report")
    report = stored(outputs.audit_report(audited(spark, sf_dir), d), "report-rows")
    outputs.write_table(outputs.report_text(report), out, "text")
    lines = spark.read.text(out, wholetext=True).select(F.explode(F.split("value", "\n")).alias("line")).where("line like '- %'").agg(F.count("*").alias("lines"))
    return report.crossJoin(F.broadcast(lines))


def snk_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown, _, d, n, unused = unknowns(spark, sf_dir)
    return outputs.unknown_report(unknown, fuzzy.match_unknowns(unknown, d, unused), n)


def fuz_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of odd keys, moved one schedule on for every third, against a dictionary of those of even keys."""
    e = samples.schema_elements(spark, sf_dir)
    known = e.where("seq % 2 = 0").select("xpath", F.col("xpath").alias("canonical_name"), "version").distinct()
    d = io.Dict(known.select("canonical_name").distinct(), known.select("canonical_name", "version", "xpath"), known.select("xpath", "canonical_name").distinct())
    moved = F.when(F.col("seq") % 3 == 0, F.lit("IRS990ScheduleA")).otherwise(F.col("schedule"))
    x = e.where("seq % 2 = 1").select(F.concat_ws("/", F.lit(""), moved, "parent_group", "element_name").alias("xpath")).distinct()
    unknown = x.select("xpath", fn.leaf_of(F.col("xpath")).alias("element_name"), fn.schedule_of(F.col("xpath")).alias("schedule"), fn.parent_of(F.col("xpath")).alias("parent_xpath"))
    parents = e.where("seq % 2 = 0").select(F.concat_ws("/", F.lit(""), "schedule", "parent_group").alias("xpath")).distinct()
    d = d._replace(xpath_index=d.xpath_index.unionByName(parents.withColumn("canonical_name", F.col("xpath"))))
    return fuzzy.match_unknowns(unknown, d, d.fields).select("xpath", "match", "score", "reason")


# --- browsing, categories, selection


def brw_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.schedules(part_fields(spark, sf_dir))


def brw_per_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.per_schedule(part_fields(spark, sf_dir))


def brw_schedule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    return browse.schedule_stats(fields, part_frequency(spark, sf_dir, fields)).withColumn("mean_present_pct", F.round("mean_present_pct", 6))


def brw_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.overall_stats(part_fields(spark, sf_dir))


def brw_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    found = browse.filter_fields(fields, part_frequency(spark, sf_dir, fields), schedule="IRS990ScheduleB", least_pct=20.0, type_="Dollar amount (USD)", version="2018v3.1", text="RING")
    return found.select("canonical_name", "label")


def brw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    return browse.by_category(fields, samples.categories(fields), part_frequency(spark, sf_dir, fields)).select("top", "sub", "canonical_name")


def brw_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.category_counts(brw_categories(spark, sf_dir))


def brw_path_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.path_runs(part_dictionary(spark, sf_dir).field_xpaths)


def brw_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.facets(part_fields(spark, sf_dir), "IRS990ScheduleA")


def cat_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    labelled = fields.where("group = 'Brand2Grp'")
    found = categories.batches(categories.remaining(fields, labelled, ["IRS990ScheduleA", "IRS990ScheduleC"]), part_frequency(spark, sf_dir, fields), 150)
    return found.select("schedule", "batch", F.size("entries").cast("long").alias("n"), F.array_join(F.transform("entries", lambda e: e["field"]), ";").alias("names"), F.array_join(F.transform("entries", lambda e: e["xpath"]), ";").alias("xpaths"))


def cat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = categories.tree(samples.categories(part_fields(spark, sf_dir)))
    return found.select(F.array_join("path", " > ").alias("path"), F.array_join("fields", ";").alias("fields"), "fields_below", F.col("depth").cast("long").alias("depth"))


def cat_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.path_counts(samples.categories(part_fields(spark, sf_dir)))


CHOSEN_SCHEDULES, CHOSEN_CATEGORIES = ["IRS990ScheduleC"], ["Brand", "IRS990ScheduleD > S", "IRS990ScheduleE > R > Brand3Grp"]


def sel_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    return select.candidates(fields, samples.categories(fields), CHOSEN_SCHEDULES, CHOSEN_CATEGORIES).select("canonical_name")


def sel_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    rows = select.candidates(fields, samples.categories(fields), CHOSEN_SCHEDULES, CHOSEN_CATEGORIES)
    return select.limit_overflow(rows, part_frequency(spark, sf_dir, fields), CHOSEN_SCHEDULES, CHOSEN_CATEGORIES, limit=20).select("canonical_name")


def sel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    rows = select.candidates(fields, samples.categories(fields), CHOSEN_SCHEDULES, CHOSEN_CATEGORIES)
    lines = select.describe(rows, part_frequency(spark, sf_dir, fields))
    return lines.withColumn("line", F.regexp_replace("line", r"freq:[\d?]+%?", "freq"))


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection from parts: element names as field names, some of which no dictionary has."""
    e = samples.schema_elements(spark, sf_dir)
    name = F.concat_ws("_", "schedule", "parent_group", "element_name")
    return e.groupBy(F.when(F.col("seq") % 15 == 0, F.lower(name)).otherwise(name).alias("field_name")).agg(F.lit("asked").alias("relevance"), F.get(F.array(F.lit("high"), F.lit("medium"), F.lit("?")), (F.min("seq") % 3).cast("int")).alias("priority"))


def sel_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.check(chosen(spark, sf_dir), part_fields(spark, sf_dir)).groupBy("valid", "priority", "schedule").agg(F.count("*").alias("n"))


def snk_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = part_fields(spark, sf_dir)
    return outputs.selection_export(chosen(spark, sf_dir), fields, samples.categories(fields), part_frequency(spark, sf_dir, fields)).select("field_name", "label", "schedule", "type", "priority", "categories", "sample_xpath")


# --- reports


def snk_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.dictionary_table(part_fields(spark, sf_dir), samples.PART_VERSIONS)


def snk_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.reference_entries(part_fields(spark, sf_dir))


def snk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup document read back: as many fields and paths as it was made of."""
    document = outputs.lookup_document(part_dictionary(spark, sf_dir)).select(F.from_json("value", io.LOOKUP).alias("d"))
    return document.select(F.col("d.metadata.total_fields").cast("long").alias("total_fields"), F.array_join("d.metadata.versions", ";").alias("versions"), F.size(F.map_keys("d.fields")).cast("long").alias("fields"), F.size(F.map_keys("d.xpath_index")).cast("long").alias("paths"))


def snk_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = part_dictionary(spark, sf_dir)
    rows = specs.from_schedule(d, "IRS990ScheduleA", part_frequency(spark, sf_dir, d.fields), samples.categories(d.fields))
    return outputs.spec_reference(rows).drop("frequency_pct")


def ext_spec_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_string(specs.groups(specs.from_schedule(part_dictionary(spark, sf_dir), "IRS990ScheduleA")))


def ext_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field-set exports as rows (one file per brand of parts): the first file that names a field wins."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    rows = part.select(F.concat("p_brand", F.lit(".json")).alias("file"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("field_name"), F.col("p_type").alias("label"))
    return one_string(io.merge_exports(rows).select("field_name", "label", "sources"))


# --- schemas


def xsd_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xsd.expand(xsd.items(samples.schema_documents(spark, sf_dir))).drop("seq")


def xsd_shared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of schemas with base types, restrictions, group references, simple content and a type that contains itself."""
    return xsd.expand(xsd.items(samples.shared_schema_documents(spark, sf_dir))).drop("seq")


def w3_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dictionary(samples.schema_documents(spark, sf_dir)).fields.select("canonical_name", "schedule", "description", "version_start", "version_end")


def val_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xsd.named_elements(samples.schema_documents(spark, sf_dir)).drop("line")


def val_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.dedup(xsd.named_elements(samples.schema_documents(spark, sf_dir))).select("name", F.length("context").cast("long").alias("size"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named elements of the schema files against a dictionary of all parts that knows one schedule by an older name."""
    older = F.regexp_replace("xpath", "^/IRS990ScheduleC/", "/IRS990ScheduleCOld/").alias("xpath")
    known = samples.schema_elements(spark, sf_dir).select(older, F.lit("x").alias("canonical_name")).distinct()
    d = io.Dict(known, known, known)
    named = validate.dedup(xsd.named_elements(samples.schema_documents(spark, sf_dir)))
    forms, _ = validate.split_shared(named)
    return validate.classify(forms, d)


def val_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms, shared = validate.split_shared(validate.dedup(xsd.named_elements(samples.schema_documents(spark, sf_dir))))
    both = forms.select(F.lit(True).alias("in_form")).unionAll(shared.select(F.lit(False)))
    return both.groupBy("in_form").agg(F.count("*").alias("n"))


def snk_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.missing_report(classified(spark, sf_dir)).select("element_name", "pattern", "schedule")


def src_schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema files in a directory for each version, read back: all of them, and those of one version."""
    out = new_folder(spark, "schema-files")
    documents = stored(samples.schema_documents(spark, sf_dir), "schema-documents")
    for version in samples.PART_VERSIONS:
        documents.where(F.col("version") == version).select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(f"{out}/{version}")
    found = None
    for chosen in (None, "2020v4.2"):
        files = xsd.schema_files(spark, out, chosen, pattern="*.txt")
        rows = xsd.items(files).where("kind = 'element'").groupBy("version").agg(F.count_distinct("path").alias("files"), F.count("*").alias("elements")).withColumn("chosen", F.lit(chosen is not None))
        found = rows if found is None else found.unionByName(rows)
    return found


# --- files: tables are written below the shared folder and read back by the library's readers


def src_filing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every filing in a file of its own."""
    texts = samples.filings(spark, sf_dir).select(F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"))
    return shred.status_counts(io.through_files(texts, shred.headers))


def src_lookup_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "lookup-file")
    outputs.write_table(outputs.lookup_document(part_dictionary(spark, sf_dir)), out, "text")
    return io.read_lookup(spark, out).xpath_index


def src_categories_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object of the dictionary's fields, as the labelling leaves it."""
    out, labels = new_folder(spark, "categories-file"), samples.categories(part_fields(spark, sf_dir))
    whole = labels.agg(F.map_from_entries(F.collect_list(F.struct("canonical_name", "paths"))).alias("field_categories"))
    whole.select(F.to_json(F.struct("field_categories"))).write.text(out)
    return categories.path_counts(io.read_categories(spark, out))


def written_tables(spark: SparkSession, sf_dir: str) -> str:
    out = new_folder(spark, "extracted")
    outputs.write_tables(out, *extract.tables_of_filings(samples.filings(spark, sf_dir), sample_specs(spark)))
    return out


def snk_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{written_tables(spark, sf_dir)}/scalar_fields")


def snk_group_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{written_tables(spark, sf_dir)}/group_ContractorCompensationGrp")


def snk_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "categories")
    outputs.write_categories(samples.categories(part_fields(spark, sf_dir)), out)
    found = spark.read.schema("path array<string>, fields array<string>, fields_below long, depth int").json(f"{out}/tree")
    return found.select(F.array_join("path", " > ").alias("path"), F.array_join("fields", ";").alias("fields"), "fields_below", F.col("depth").cast("long").alias("depth"))


def ext_export_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export file for each brand of parts, in order of brand."""
    part, out = spark.read.parquet(f"{sf_dir}/part.parquet"), new_folder(spark, "exports")
    xpaths = lambda name: F.create_map(F.lit("2020v1.0"), F.concat(F.lit("/"), F.replace(name, F.lit(" "), F.lit(""))))
    ordered = F.array_sort(F.collect_list(F.struct("p_partkey", "p_name", "p_type")))
    fields = F.transform(ordered, lambda x: F.struct(x["p_name"].alias("field_name"), x["p_type"].alias("label"), xpaths(x["p_name"]).alias("xpaths")))
    files = part.groupBy(F.col("p_brand").alias("query")).agg(fields.alias("fields"))
    files.repartitionByRange("query").sortWithinPartitions("query").write.option("maxRecordsPerFile", 1).json(out)
    return specs.from_exports(spark, out).select("field_name", "label", F.size("sources").cast("long").alias("sources"), "sample_xpath")


def val_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("name", "found")


def val_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.coverage(classified(spark, sf_dir)).withColumn("coverage_pct", F.round("coverage_pct", 6))


def val_missing_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validate.missing_by_pattern(classified(spark, sf_dir))
    return found.select("pattern", "n", F.array_join("examples", ";").alias("examples"))


def val_missing_by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.missing_by_schedule(classified(spark, sf_dir))


NAMES = """src_headers src_headers_by_schema src_packed src_status src_first_filings src_elements src_forms_present ext_resolve ext_scalars ext_scalars_pivot ext_groups
ext_group_counts ext_preset_revenue ext_preset_pay ext_preset_expenses ext_preset_support ext_preset_assets ext_officers ext_older_names dic_exact dic_merge dic_fields dic_index dic_aliases dic_counts fn_names fn_versions fn_values
fn_similarity aud_filing_counts aud_path_stats aud_frequency aud_unknown aud_missing_versions aud_unused aud_coverage aud_schedule_coverage
aud_warnings aud_proposals aud_summary snk_unknown snk_report fuz_parts brw_schedules brw_per_schedule brw_schedule_stats brw_overall brw_filter
brw_categories brw_category_counts brw_path_runs brw_facets cat_batches cat_tree cat_paths sel_candidates sel_overflow sel_lines sel_check
snk_selection snk_dictionary snk_reference snk_lookup snk_specs ext_spec_groups ext_exports xsd_elements xsd_shared_types w3_dictionary val_named val_dedup
val_shared snk_missing src_filing_files src_lookup_file src_categories_file snk_tables snk_group_tables src_schema_files snk_categories ext_export_specs val_classify val_coverage val_missing_by_pattern val_missing_by_schedule""".split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES}
