"""Categories of fields: batches to label, and what the labels say."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def remaining(fields: DataFrame, labelled: DataFrame | None = None, schedules: list[str] | None = None) -> DataFrame:
    """CAT-2. Fields still to label, of the given schedules."""
    rows = fields if schedules is None else fields.where(F.col("schedule").isin(schedules))
    return rows if labelled is None else rows.join(labelled.select("canonical_name").distinct(), "canonical_name", "left_anti")


def batches(fields: DataFrame, frequency: DataFrame | None = None, size: int = 200) -> DataFrame:
    """CAT-1. (schedule, batch, entries): each schedule's fields in order of name, ``size`` at a time.

    The representative path is that of the smallest version string.
    """
    first = F.coalesce(F.col("xpaths")[F.array_min(F.map_keys("xpaths"))], F.lit(""))
    rows = fields.withColumn("xpath", first)
    if frequency is not None:
        rows = rows.join(frequency.select("canonical_name", "present_pct", "nontrivial_pct"), "canonical_name", "left")
    else:
        rows = rows.withColumns({"present_pct": F.lit(None).cast("double"), "nontrivial_pct": F.lit(None).cast("double")})
    number = F.row_number().over(Window.partitionBy("schedule").orderBy("canonical_name")) - 1
    entry = F.struct(F.col("canonical_name").alias("field"), "label", "type", "description", "xpath", "present_pct", "nontrivial_pct")
    return rows.withColumn("batch", F.floor(number / size)).groupBy("schedule", "batch").agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def paths(labels: DataFrame) -> DataFrame:
    """CAT-3. (canonical_name, path) of labels (canonical_name, paths); empty paths don't count, repeats stay."""
    return labels.select("canonical_name", F.explode("paths").alias("path")).where(F.size("path") > 0)


def tree(labels: DataFrame) -> DataFrame:
    """CAT-3. (path, depth, fields, fields_below): every node of the tree, its own distinct fields and those at or below it."""
    every = paths(labels)
    nodes = every.select("canonical_name", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda k: F.slice("path", 1, k))).alias("node"), "path")
    own = F.collect_set(F.when(F.size("node") == F.size("path"), F.col("canonical_name")))
    return nodes.groupBy(F.col("node").alias("path")).agg(F.array_sort(own).alias("fields"), F.count_distinct("canonical_name").alias("fields_below")).withColumn("depth", F.size("path"))


def path_counts(labels: DataFrame) -> DataFrame:
    """CAT-4. (path, n): fields per category path, in order."""
    return paths(labels).groupBy(F.array_join("path", " > ").alias("path")).agg(F.count("*").alias("n")).orderBy("path")
