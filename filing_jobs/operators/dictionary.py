"""The cross-version dictionary: exact paths, renames by equal descriptions, unique names, index, older names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import canonical_name, inferred_description, label, older_name, type_name, version_key
from filing_jobs.sources.io import Dict, xpaths_of


def sorted_versions(versions: Column) -> Column:
    """Version strings in the dictionary's order, equal keys by the string."""
    return F.transform(F.array_sort(F.transform(versions, lambda v: F.struct(version_key(v).alias("key"), v.alias("v")))), lambda x: x["v"])


def exact_fields(elements: DataFrame) -> DataFrame:
    """DIC-1. One field per path: its newest element's properties, the newest documentation that is not empty.

    Elements of equal versions: the last in ``seq``.
    """
    rows = elements.withColumn("place", F.struct(version_key(F.col("version")).alias("key"), F.col("seq").alias("seq")))
    kept = F.struct("element_name", "xsd_type", "parent_group", "is_repeating", "schedule")
    documented = F.when(F.coalesce("documentation", F.lit("")) != "", F.col("place"))
    found = rows.groupBy("xpath").agg(F.max_by(kept, "place").alias("e"), F.max_by("documentation", documented).alias("doc"), F.collect_set("version").alias("seen"))  # versions: tens
    versions = sorted_versions(F.col("seen"))
    return found.select(
        canonical_name(F.col("xpath")).alias("canonical_name"), F.col("e.schedule").alias("schedule"), label(F.col("e.element_name")).alias("label"),
        type_name(F.col("e.xsd_type")).alias("type"), F.col("e.xsd_type").alias("raw_type"), F.coalesce("doc", inferred_description(F.col("xpath"), F.col("e.element_name"))).alias("description"),
        F.col("e.parent_group").alias("group"), F.col("e.is_repeating").alias("repeating"), versions.alias("versions"),
        F.map_from_arrays(versions, F.transform(versions, lambda _: F.col("xpath"))).alias("xpaths"), "xpath",
    )


def merge_renames(fields: DataFrame) -> DataFrame:
    """DIC-2. Fields of one schedule, group and description in versions that don't overlap become one.

    In each such set the field with the greatest last version (then the greatest path) takes the others in,
    in ascending order, as far as their versions are new to what it has taken so far. Of fields with equal
    versions only the first can be taken, so a set is folded over one field for each list of versions it has,
    however many fields share a description.
    """
    said = F.lower(F.trim("description")).alias("said")
    last = version_key(F.element_at("versions", -1))
    member = F.struct(last.alias("last"), F.col("xpath"), F.col("versions"), F.map_entries("xpaths").alias("xpaths"))
    spoken = fields.where(F.coalesce("description", F.lit("")) != "")
    ends = spoken.groupBy("schedule", "group", said, "versions").agg(F.min(member).alias("first"), F.max(member).alias("most"))
    sets = ends.groupBy("schedule", "group", "said").agg(F.array_sort(F.collect_list("first")).alias("firsts"), F.max("most").alias("primary"))
    sets = sets.where(F.size("firsts") > 1)  # fields of one list of versions overlap
    sets = sets.withColumn("m", F.filter("firsts", lambda x: x["xpath"] != F.col("primary.xpath")))
    primary = F.col("primary")
    start = F.struct(primary["versions"].alias("versions"), primary["xpaths"].alias("xpaths"), F.array().cast("array<string>").alias("taken"))

    def fold(acc: Column, x: Column) -> Column:
        joins = ~F.arrays_overlap(acc["versions"], x["versions"])
        taken = F.struct(F.concat(acc["versions"], x["versions"]).alias("versions"), F.concat(acc["xpaths"], x["xpaths"]).alias("xpaths"), F.concat(acc["taken"], F.array(x["xpath"])).alias("taken"))
        return F.when(joins, taken).otherwise(acc)

    merged = sets.withColumn("acc", F.aggregate("m", start, fold))
    # only what changes meets the fields again: the first of a set, which has all versions, and those it took
    changed = sets.withColumn("acc", F.aggregate("m", start, fold)).where(F.size("acc.taken") > 0)
    roles = F.concat(F.array(F.struct(primary["xpath"].alias("xpath"), F.lit(False).alias("gone"))), F.transform("acc.taken", lambda x: F.struct(x.alias("xpath"), F.lit(True).alias("gone"))))
    lead = lambda c: F.when(~F.col("role.gone"), c)
    changed = changed.select("schedule", "group", "said", F.explode(roles).alias("role"), "acc")
    changed = changed.select(*(F.col(c).alias(f"r_{c}") for c in ("schedule", "group", "said")), F.col("role.xpath").alias("r_xpath"), F.col("role.gone").alias("gone"), lead(sorted_versions(F.col("acc.versions"))).alias("all_versions"), lead(F.map_from_entries("acc.xpaths")).alias("all_xpaths"))
    same = (F.col("xpath") == F.col("r_xpath")) & F.col("schedule").eqNullSafe(F.col("r_schedule")) & F.col("group").eqNullSafe(F.col("r_group")) & said.eqNullSafe(F.col("r_said"))
    out = fields.join(changed, same, "left").where(~F.coalesce("gone", F.lit(False)))
    return out.withColumns({"versions": F.coalesce("all_versions", "versions"), "xpaths": F.coalesce("all_xpaths", "xpaths")}).select(fields.columns)


def resolve_collisions(fields: DataFrame) -> DataFrame:
    """DIC-3. A name held more than once gets its schedule in front, for every holder."""
    often = fields.groupBy("canonical_name").count().where("count > 1").select("canonical_name", F.lit(True).alias("often"))
    return fields.join(often, "canonical_name", "left").withColumn("canonical_name", F.when(F.col("often"), F.concat("schedule", F.lit("_"), "canonical_name")).otherwise(F.col("canonical_name"))).drop("often")


def last_of_name(fields: DataFrame) -> DataFrame:
    """DIC-3. Of fields that still share a name the last by schedule, then path."""
    columns = [c for c in fields.columns if c != "canonical_name"]
    return fields.groupBy("canonical_name").agg(F.max_by(F.struct(*columns), F.struct("schedule", "xpath")).alias("f")).select("canonical_name", "f.*")


def xpath_index(fields: DataFrame) -> DataFrame:
    """DIC-4. (xpath, canonical_name) of every path a field ever had; of several names the greatest."""
    return xpaths_of(fields).groupBy("xpath").agg(F.max("canonical_name").alias("canonical_name"))


def add_aliases(index: DataFrame) -> DataFrame:
    """DIC-5. The index with the older names of leaves, where that path is not taken."""
    older = older_name(F.substring_index("xpath", "/", -1))
    aliases = index.where(older.isNotNull()).select(F.concat(F.regexp_replace("xpath", "[^/]*$", ""), older).alias("xpath"), "canonical_name")
    fresh = aliases.join(index, "xpath", "left_anti").groupBy("xpath").agg(F.max("canonical_name").alias("canonical_name"))
    return index.unionByName(fresh)


def finished(fields: DataFrame) -> DataFrame:
    """The columns of the dictionary's fields table."""
    return fields.select("canonical_name", "schedule", "label", "type", "raw_type", "description", "group", "repeating", "xpaths", F.coalesce(F.get("versions", F.lit(0)), F.lit("")).alias("version_start"), F.coalesce(F.element_at("versions", -1), F.lit("")).alias("version_end"))


def build(elements: DataFrame) -> Dict:
    """DIC-1 to 5. The dictionary of all schema elements."""
    fields = finished(last_of_name(resolve_collisions(merge_renames(exact_fields(elements)))))
    return Dict(fields, xpaths_of(fields), add_aliases(xpath_index(fields)))


def counts(elements: DataFrame, fields: DataFrame) -> DataFrame:
    """DIC-6. One row: elements, fields, repeating fields and others."""
    each = fields.agg(F.count("*").alias("fields"), F.count_if("repeating").alias("repeating"), F.count_if(~F.col("repeating")).alias("not_repeating"))
    return elements.agg(F.count("*").alias("elements")).crossJoin(F.broadcast(each))
