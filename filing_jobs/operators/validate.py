"""What the schema files hold and the dictionary lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.sources.io import Dict


def dedup(named: DataFrame) -> DataFrame:
    """VAL-2. One row per element name: the longest context, then the first in order of file and line."""
    columns = [c for c in named.columns if c != "name"]
    first = F.struct(-F.length("context"), "file", "line")
    return named.groupBy("name").agg(F.min_by(F.struct(*columns), first).alias("e")).select("name", "e.*")


def split_shared(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL-3. Elements of forms, and those of shared types."""
    return named.where("schedule != ''"), named.where("schedule = ''")


def classify(forms: DataFrame, d: Dict) -> DataFrame:
    """VAL-4. Each form element with ``found``: leaf, group (a name inside a path), or missing."""
    parts = F.split(F.regexp_replace("xpath", "^/+|/+$", ""), "/")
    leaves = d.xpath_index.select(F.element_at(parts, -1).alias("name")).distinct().withColumn("leaf", F.lit(True))
    inside = d.xpath_index.select(F.explode(parts).alias("name")).distinct().withColumn("inside", F.lit(True))
    rows = forms.join(leaves, "name", "left").join(inside, "name", "left")
    return rows.withColumn("found", F.when(F.col("leaf"), "leaf").when(F.col("inside"), "group").otherwise("missing")).drop("leaf", "inside")


def coverage(classified: DataFrame) -> DataFrame:
    """VAL-4. One row: elements, covered ones, and those in percent (0 without elements)."""
    rows = classified.agg(F.count("*").alias("elements"), F.count_if(F.expr("found = 'leaf'")).alias("leaves"), F.count_if(F.expr("found = 'group'")).alias("groups"), F.count_if(F.expr("found = 'missing'")).alias("missing"))
    return rows.withColumn("coverage_pct", F.when(F.col("elements") > 0, (F.col("leaves") + F.col("groups")) * 100.0 / F.col("elements")).otherwise(0.0))


def missing_by_pattern(classified: DataFrame, examples: int = 10) -> DataFrame:
    """VAL-5. Missing elements per pattern, the most frequent first, with their first names."""
    missing = classified.where("found = 'missing'")
    ranked = missing.withColumn("k", F.row_number().over(Window.partitionBy("pattern").orderBy("name")))
    return ranked.groupBy("pattern").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("k") <= examples, F.col("name")))).alias("examples")).orderBy(F.desc("n"), "pattern")


def missing_by_schedule(classified: DataFrame) -> DataFrame:
    """VAL-5. Missing elements per schedule."""
    return classified.where("found = 'missing'").groupBy("schedule").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "schedule")
