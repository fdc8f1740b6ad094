"""Field specs: what to extract, from a dictionary's schedule or from exported selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import group_of
from filing_jobs.sources.io import Dict, read_exports

COLUMNS = ["field_name", "label", "schedule", "type", "description", "frequency_pct", "priority", "relevance", "categories", "xpaths", "sources", "sample_xpath", "group_name", "group_prefix", "relative_xpath", "ord"]


def with_group(rows: DataFrame) -> DataFrame:
    """The repeating group by the path of the smallest version string."""
    first = F.coalesce(F.col("xpaths")[F.array_min(F.map_keys("xpaths"))], F.lit(""))
    rows = rows.withColumn("sample_xpath", first).withColumn("g", group_of(F.col("sample_xpath")))
    return rows.select("*", F.col("g.name").alias("group_name"), F.col("g.prefix").alias("group_prefix"), F.col("g.relative").alias("relative_xpath")).drop("g")


def from_schedule(d: Dict, schedule: str, frequency: DataFrame | None = None, categories: DataFrame | None = None) -> DataFrame:
    """EXT-1. The leaf fields of one schedule, with frequency and top categories where given; ordered by name."""
    rows = d.fields.where((F.col("schedule") == schedule) & ~F.col("type").eqNullSafe("(group)")).withColumnRenamed("canonical_name", "field_name")
    if frequency is not None:
        rows = rows.join(frequency.select(F.col("canonical_name").alias("field_name"), F.col("present_pct").alias("frequency_pct")), "field_name", "left")
    else:
        rows = rows.withColumn("frequency_pct", F.lit(None).cast("double"))
    if categories is not None:
        tops = F.array_distinct(F.transform(F.filter("paths", lambda p: F.size(p) > 0), lambda p: p[0]))
        rows = rows.join(categories.select(F.col("canonical_name").alias("field_name"), tops.alias("categories")), "field_name", "left")
    else:
        rows = rows.withColumn("categories", F.lit(None).cast("array<string>"))
    rows = rows.withColumns({"priority": F.lit(""), "relevance": F.lit(""), "categories": F.coalesce("categories", F.array().cast("array<string>")), "sources": F.array(F.lit(f"dictionary:{schedule}")), "ord": F.struct(F.lit("").alias("file"), F.lit(0).alias("pos"))})
    return with_group(rows).select(COLUMNS)


def from_exports(spark: SparkSession, root: str) -> DataFrame:
    """EXT-2. The fields of a directory of exported selections."""
    return with_group(read_exports(spark, root)).select(COLUMNS)


def scalars_of(specs: DataFrame) -> DataFrame:
    """EXT-3. The fields outside repeating groups."""
    return specs.where("group_name = ''")


def groups(specs: DataFrame) -> DataFrame:
    """EXT-3. One row per group name: prefix and schedule of its first member, the members in order."""
    first = F.struct("ord", "field_name")
    return specs.where("group_name != ''").groupBy("group_name").agg(
        F.min_by("group_prefix", first).alias("group_prefix"),
        F.min_by("schedule", first).alias("schedule"),
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "field_name"))), lambda x: x["field_name"]).alias("children"),
    )


def spec_xpaths(specs: DataFrame) -> DataFrame:
    """(canonical_name, version, xpath) of the fields."""
    return specs.select(F.col("field_name").alias("canonical_name"), F.explode("xpaths").alias("version", "xpath"))
