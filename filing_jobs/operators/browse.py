"""Looking through a dictionary: counts, filters, categories, how paths changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNCATEGORISED, GENERAL = "Uncategorized", "(General)"


def schedules(fields: DataFrame) -> DataFrame:
    """EXT-8. Schedules with at least one leaf field: leaf fields and groups; empty schedules don't count."""
    rows = fields.where(F.coalesce("schedule", F.lit("")) != "")
    group = F.col("type").eqNullSafe("(group)")
    return rows.groupBy("schedule").agg(F.count_if(~group).alias("leaf_fields"), F.count_if(group).alias("groups")).where("leaf_fields > 0").orderBy("schedule")


def per_schedule(fields: DataFrame) -> DataFrame:
    """BRW-1. Fields per schedule, the most first."""
    return fields.groupBy("schedule").agg(F.count("*").alias("fields")).orderBy(F.desc("fields"), "schedule")


def schedule_stats(fields: DataFrame, frequency: DataFrame) -> DataFrame:
    """BRW-2. Per schedule: fields, distinct versions, mean present percentage of the fields that have one (0 if none)."""
    rows = fields.join(frequency.select("canonical_name", "present_pct"), "canonical_name", "left")
    versions = fields.select("schedule", F.explode(F.map_keys("xpaths")).alias("v")).groupBy("schedule").agg(F.count_distinct("v").alias("versions"))
    found = rows.groupBy("schedule").agg(F.count("*").alias("fields"), F.coalesce(F.avg("present_pct"), F.lit(0.0)).alias("mean_present_pct"))
    return found.join(versions, "schedule", "left").select("schedule", "fields", F.coalesce("versions", F.lit(0)).alias("versions"), "mean_present_pct")


def overall_stats(fields: DataFrame) -> DataFrame:
    """BRW-3. One row: fields, schedules, versions."""
    versions = fields.select(F.explode(F.map_keys("xpaths")).alias("v")).agg(F.count_distinct("v").alias("versions"))
    return fields.agg(F.count("*").alias("fields"), F.count_distinct("schedule").alias("schedules")).crossJoin(F.broadcast(versions))


def filter_fields(fields: DataFrame, frequency: DataFrame, *, schedule: str | None = None, least_pct: float = 0.0, type_: str | None = None, version: str | None = None, text: str = "") -> DataFrame:
    """BRW-4. Fields by schedule, frequency (missing counts as 0), type, version and a part of name, label or description."""
    rows = fields.join(frequency.select("canonical_name", "present_pct"), "canonical_name", "left")
    if schedule is not None:
        rows = rows.where(F.col("schedule") == schedule)
    if least_pct > 0:
        rows = rows.where(F.coalesce("present_pct", F.lit(0.0)) >= least_pct)
    if type_ is not None:
        rows = rows.where(F.col("type") == type_)
    if version is not None:
        rows = rows.where(F.map_contains_key("xpaths", version))
    if text:
        rows = rows.where(F.lower(F.concat_ws(" ", "canonical_name", "label", "description")).contains(text.lower()))
    return rows


def by_category(fields: DataFrame, categories: DataFrame, frequency: DataFrame) -> DataFrame:
    """BRW-5. (top, sub, canonical_name, present_pct, place): fields under their categories, the most frequent first.

    The sub-category is the rest of the path; a path of one level is General, which comes first; no path is Uncategorized.
    """
    rows = fields.select("canonical_name").join(categories.select("canonical_name", "paths"), "canonical_name", "left").join(frequency.select("canonical_name", "present_pct"), "canonical_name", "left")
    rows = rows.select("canonical_name", "present_pct", F.explode_outer("paths").alias("p"))
    size = F.coalesce(F.size("p"), F.lit(0))
    top = F.when(size > 0, F.get("p", F.lit(0))).otherwise(UNCATEGORISED)
    sub = F.when(size > 1, F.array_join(F.slice("p", 2, F.greatest(size, F.lit(1))), " > ")).otherwise(GENERAL)
    rows = rows.select(top.alias("top"), sub.alias("sub"), "canonical_name", "present_pct")
    return rows.orderBy("top", F.col("sub") != GENERAL, "sub", F.desc(F.coalesce("present_pct", F.lit(0.0))), "canonical_name")


def category_counts(grouped: DataFrame) -> DataFrame:
    """BRW-5. Distinct fields per top category."""
    return grouped.groupBy("top").agg(F.count_distinct("canonical_name").alias("fields"))


def path_runs(field_xpaths: DataFrame) -> DataFrame:
    """BRW-6. Each path a field has had: the first and last version (in order of the strings) and how many."""
    return field_xpaths.groupBy("canonical_name", "xpath").agg(F.min("version").alias("first"), F.max("version").alias("last"), F.count("*").alias("versions"))


def facets(fields: DataFrame, schedule: str | None = None) -> DataFrame:
    """BRW-7. (facet, value): the distinct types of a schedule that are not empty, and all versions."""
    rows = fields if schedule is None else fields.where(F.col("schedule") == schedule)
    types = rows.where(F.coalesce("type", F.lit("")) != "").select(F.lit("type").alias("facet"), F.col("type").alias("value"))
    versions = fields.select(F.lit("version").alias("facet"), F.explode(F.map_keys("xpaths")).alias("value"))
    return types.unionByName(versions).distinct().orderBy("facet", "value")
