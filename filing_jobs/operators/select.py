"""Choosing fields: candidates by schedule and category, and checks of what was chosen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIMIT = 1500


STEP = " > "


def chosen_table(spark: SparkSession, chosen: DataFrame | list[str], name: str) -> DataFrame:
    """(name): a list or the first column of a table, distinct."""
    rows = spark.createDataFrame([(c,) for c in chosen], f"{name} string") if isinstance(chosen, list) else chosen.select(F.col(f"`{chosen.columns[0]}`").alias(name))
    return rows.where(F.col(name).isNotNull()).distinct()


def upwards(path: Column) -> Column:
    """The path and all that are above it."""
    parts = F.split(path, STEP)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), STEP))


def in_categories(categories: DataFrame, chosen: DataFrame) -> DataFrame:
    """(canonical_name) of fields with a path that is a chosen category, or below or above one.

    Of two paths one is above the other, or both are equal, where the whole of one is among the other's ``upwards``: two
    joins with equality, however many categories are chosen.
    """
    paths = categories.select("canonical_name", F.explode("paths").alias("p")).select("canonical_name", F.array_join("p", STEP).alias("path"))
    below = paths.select("canonical_name", F.explode(upwards(F.col("path"))).alias("category")).join(chosen, "category", "left_semi")
    above = paths.withColumnRenamed("path", "category").join(chosen.select(F.explode(upwards(F.col("category"))).alias("category")).distinct(), "category", "left_semi")
    return below.select("canonical_name").unionByName(above.select("canonical_name")).distinct()


def hits(fields: DataFrame, categories: DataFrame, schedules: DataFrame | list[str], chosen: DataFrame | list[str]) -> DataFrame:
    """The fields with their ``paths``, ``by_schedule`` and ``by_category``."""
    spark = fields.sparkSession
    found = in_categories(categories, chosen_table(spark, chosen, "category")).withColumn("by_category", F.lit(True))
    named = chosen_table(spark, schedules, "schedule").withColumn("by_schedule", F.lit(True))
    rows = fields.join(categories.select("canonical_name", "paths"), "canonical_name", "left").join(found, "canonical_name", "left").join(named, "schedule", "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("by_category", "by_schedule")})


def candidates(fields: DataFrame, categories: DataFrame, schedules: DataFrame | list[str], chosen: DataFrame | list[str]) -> DataFrame:
    """SEL-1. Fields of the schedules, or of a category equal to, below or above a chosen one; with their ``paths``.

    Schedules and categories are lists or tables of any length.
    """
    return hits(fields, categories, schedules, chosen).where("by_schedule or by_category").select(*fields.columns, "paths")


def limit_overflow(rows: DataFrame, frequency: DataFrame, schedules: DataFrame | list[str], chosen: DataFrame | list[str], limit: int = LIMIT) -> DataFrame:
    """SEL-2. More than ``limit`` candidates: those ever present, if any; still more: those of schedule and category both, if any."""
    if rows.count() > limit:
        present = rows.join(frequency.where("present_pct > 0").select("canonical_name"), "canonical_name", "left_semi")
        rows = rows if present.isEmpty() else present
    if rows.count() > limit:
        both = hits(rows.drop("paths"), rows, schedules, chosen).where("by_schedule and by_category").select(rows.columns)
        rows = rows if both.isEmpty() else both
    return rows


def describe(rows: DataFrame, frequency: DataFrame) -> DataFrame:
    """SEL-3. (canonical_name, line): one readable line per candidate, in order of name."""
    found = rows.join(frequency.select("canonical_name", "present_pct"), "canonical_name", "left")
    share = F.when(F.col("present_pct").isNull(), "?").otherwise(F.format_string("%.0f%%", "present_pct"))
    cats = F.array_join(F.transform(F.coalesce("paths", F.array().cast("array<array<string>>")), lambda p: F.array_join(p, " > ")), "; ")
    parts = ["canonical_name", "label", "type", "schedule", "description"]
    line = F.concat_ws(" | ", *(F.coalesce(F.col(c), F.lit("")) for c in parts), F.concat(F.lit("freq:"), share), F.concat(F.lit("cats:"), cats))
    return found.select("canonical_name", line.alias("line")).orderBy("canonical_name")


def check(selected: DataFrame, fields: DataFrame) -> DataFrame:
    """SEL-4. The selection (field_name, relevance, priority) with ``valid``, its schedule, and priority high, medium or low."""
    known = fields.select(F.col("canonical_name").alias("field_name"), "schedule").withColumn("valid", F.lit(True))
    rows = selected.join(known, "field_name", "left").withColumn("valid", F.coalesce("valid", F.lit(False)))
    return rows.withColumn("priority", F.when(F.col("priority").isin("high", "medium", "low"), F.col("priority")).otherwise("low"))
