"""Which path a field has in a filing's schema version: an as-of match with fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import filing_version_key


def places(field_xpaths: DataFrame, asked: DataFrame) -> DataFrame:
    """(version, place) of the asked versions: what decides their paths, whatever the field.

    A place is the version itself where the dictionary has it, its year where the dictionary has that, and the greatest
    key of the dictionary below its own. The dictionary's versions are tens; versions of filings are free text, and any
    number of them share few places.
    """
    known = field_xpaths.select("version").distinct().select("version", filing_version_key(F.col("version")).alias("key")).collect()
    keys = sorted({(r["key"]["year"], r["key"]["part"]) for r in known})
    key = F.col("key")
    pair = lambda k: F.struct(F.lit(k[0]).alias("year"), F.lit(k[1]).alias("part"))
    below = F.coalesce(*(F.when(pair(k) < key, pair(k)) for k in reversed(keys)), F.lit(None).cast("struct<year:int,part:int>"))
    exact = F.when(F.col("version").isin([r["version"] for r in known]), F.col("version"))
    year = F.when(key["year"].isin(sorted({y for y, _ in keys})), key["year"])
    rows = asked.select(F.coalesce("version", F.lit("")).alias("version")).distinct().withColumn("key", filing_version_key(F.col("version")))
    return rows.select("version", F.struct(exact.alias("exact"), year.alias("year"), below.alias("below")).alias("place"))


def resolve_paths(field_xpaths: DataFrame, versions: DataFrame, *, field_col: str = "canonical_name") -> DataFrame:
    """EXT-4. (field, version, xpath, rule) of every field for every filing version.

    Rules in order: 1 the version itself; 2 the highest of the same year; 3 the nearest lower one; 4 the
    highest of all. Equal keys: the greatest version string. Each field is resolved once for each place that the
    asked versions have (bounded by the dictionary), from its own row; versions then meet fields by place, with equality.
    """
    asked = places(field_xpaths, versions)
    # at most a few places for each version of the dictionary; as text, since a place has parts that may be missing
    name = F.to_json("place")
    found = [r["place"] for r in asked.select("place").distinct().collect()]
    of = lambda x, kind: F.lit(x).cast(kind)

    def literal(p) -> Column:
        below = F.struct(of(p["below"]["year"], "int").alias("year"), of(p["below"]["part"], "int").alias("part")) if p["below"] else of(None, "struct<year:int,part:int>")
        return F.struct(of(p["exact"], "string").alias("exact"), of(p["year"], "int").alias("year"), below.alias("below"))

    every = F.array(*map(literal, found)) if found else F.array().cast("array<struct<exact:string,year:int,below:struct<year:int,part:int>>>")
    own = F.struct(filing_version_key(F.col("version")).alias("key"), F.col("version").alias("own"), "xpath")
    fields = field_xpaths.groupBy(F.col(field_col).alias("field")).agg(F.collect_list(own).alias("own"))  # the field's versions: tens
    p = F.col("place")

    def ranked(x: Column) -> Column:
        rule = F.when(x["own"].eqNullSafe(p["exact"]), 1).when(x["key"]["year"] == p["year"], 2).when(x["key"] <= p["below"], 3).otherwise(4)
        return F.struct((-rule).alias("rule"), x["key"].alias("key"), x["own"].alias("own"), x["xpath"].alias("xpath"))

    best = fields.withColumn("place", F.explode(every)).withColumn("best", F.array_max(F.transform("own", ranked)))
    best = best.select("field", name.alias("at"), F.col("best.xpath").alias("xpath"), (-F.col("best.rule")).alias("rule"))
    return asked.withColumn("at", name).join(best, "at").select("field", "version", "xpath", "rule")
