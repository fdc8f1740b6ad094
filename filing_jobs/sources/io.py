"""Reading filings, dictionaries, frequencies, categories and field-set exports."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_jobs.store import delete_folder, new_folder, stored


class Dict(NamedTuple):
    """A dictionary as tables: fields, (canonical_name, version, xpath), (xpath, canonical_name)."""

    fields: DataFrame
    field_xpaths: DataFrame
    xpath_index: DataFrame


FIELDS = "canonical_name string, schedule string, label string, type string, raw_type string, description string, `group` string, repeating boolean, xpaths map<string,string>, version_start string, version_end string"
FREQUENCY = "canonical_name string, present_count long, present_pct double, nontrivial_count long, nontrivial_pct double"
CATEGORIES = "canonical_name string, paths array<array<string>>"
LOOKUP = "metadata struct<versions:array<string>,total_fields:int>, fields map<string,struct<schedule:string,label:string,type:string,raw_type:string,description:string,`group`:string,repeating:boolean,xpaths:map<string,string>,version_start:string,version_end:string>>, xpath_index map<string,string>"
EXPORT = "query string, exported_at string, fields array<struct<field_name:string,label:string,schedule:string,type:string,description:string,frequency_pct:double,priority:string,relevance:string,categories:array<string>,xpaths:map<string,string>>>"


def read_filings(spark: SparkSession, root: str, limit: int | None = None, pattern: str = "*.[xX][mM][lL]") -> DataFrame:
    """SRC-1, SRC-2. (path, content binary) of all XML files under ``root``; of the first ``limit`` in order of path.

    Bytes keep the declared encoding. With a limit only the chosen files' content is kept: the names are
    sorted alone and joined back.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "content")
    return files if limit is None else first_filings(files, limit)


def first_filings(filings: DataFrame, limit: int) -> DataFrame:
    """SRC-2. The first filings in order of path."""
    chosen = filings.select("path").orderBy("path").limit(limit)
    return filings.join(F.broadcast(chosen) if limit <= 100_000 else chosen, "path", "left_semi")


#: Small files that lie there at a time, and bytes that opening one counts for when they are dealt to tasks.
FILES, OPENING = 100_000, "16k"
#: A file for each row, put in its place by the task and not by the driver. On a local disk without a checksum's file beside each: they are read once, at once.
EACH = {"maxRecordsPerFile": "1", "mapreduce.fileoutputcommitter.algorithm.version": "2", "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def through_files(texts: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """SRC-1. ``read``, which takes filings one by one, of files that hold a row of ``texts`` (one string column) each.

    All rows are written and read back, about FILES of them at a time: a part's files are deleted before the next
    part's are written, so neither the disk nor the driver's listing holds them all. Files are dealt to tasks by
    OPENING, since Spark's own 4 MB for opening one would make a task for every few.
    """
    spark = texts.sparkSession
    held, out, own = stored(texts, "file-texts"), new_folder(spark, "file-rows"), "spark.sql.files.openCostInBytes"
    parts, tasks, before = max(1, -(-held.count() // FILES)), 2 * spark.sparkContext.defaultParallelism, spark.conf.get(own)
    dealt = stored(held.withColumn("part", F.monotonically_increasing_id() % parts), "file-parts", by="part")
    for k in range(parts):
        folder = new_folder(spark, "files")
        dealt.where(F.col("part") == k).drop("part").repartition(tasks).write.options(**EACH).text(folder)
        files = read_filings(spark, folder, pattern="*.txt").where(F.octet_length("content") > 0)  # a row ends with a line's end; a task without rows may leave an empty file
        spark.conf.set(own, OPENING)
        try:
            found = read(files)
            found.write.mode("append").parquet(out)
        finally:
            spark.conf.set(own, before)
        delete_folder(spark, folder)
    return spark.read.schema(found.schema).parquet(out)


#: A read partition's load is counted in so many parts of its bound.
UNITS = 1024


def listing(spark: SparkSession, root: str, pattern: str = "*.[xX][mM][lL]") -> DataFrame:
    """SRC-1. (path, length) of the files that ``read_filings`` reads, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length")


def first_fit(classes: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """First-fit decreasing of files of equal sizes at once: rows (size, first rank, last rank, bin, files of that size in a bin).

    ``classes``: (size in units, files), the greatest size first. The files of a row go to bins from ``bin`` on, so many
    to each. Bins that are equally full are one entry, so the work follows the number of sizes and not of files.
    """
    out, bins, made = [], [], 0  # bins: [first, number, room] in order of their making
    for size, files in classes:
        rank, after = 1, []
        for first, number, room in bins:
            each = min(room // size, files - rank + 1) if size <= room else 0
            if not each or rank > files:
                after.append([first, number, room])
                continue
            whole = min(number, (files - rank + 1) // (room // size))
            if whole:
                out.append((size, rank, rank + whole * (room // size) - 1, first, room // size))
                after.append([first, whole, room - (room // size) * size])
                rank += whole * (room // size)
            left = min(files - rank + 1, room // size - 1) if whole < number else 0
            if left:
                out.append((size, rank, rank + left - 1, first + whole, left))
                after.append([first + whole, 1, room - left * size])
                rank += left
            rest = number - whole - bool(left)
            if rest:
                after.append([first + whole + bool(left), rest, room])
        left = files - rank + 1
        if left > 0:
            each = max(1, UNITS // size)
            for number, held in ((left // each, each), (1, left % each)):
                if number and held:
                    out.append((size, rank, rank + number * held - 1, made, held))
                    after.append([made, number, max(0, UNITS - held * size)])
                    rank, made = rank + number * held, made + number
        bins = after
    return out


def pack_files(files: DataFrame, most_bytes: int) -> DataFrame:
    """SRC-1. (path, length, bin): files dealt into bins of at most ``most_bytes`` by first-fit decreasing; a larger file has its own.

    Loads are counted in UNITS parts of the bound, rounded up; files of one size go in order of path. To the driver come
    the numbers of files of at most UNITS + 1 sizes and of each range of paths; files are ranked within ranges.
    """
    spark = files.sparkSession
    unit = -(-most_bytes // UNITS)
    units = F.least(F.greatest(F.ceil(F.col("length") / unit), F.lit(1)), F.lit(UNITS)).cast("int")
    sized = files.select("path", "length", units.alias("units"))
    ranges = sized.repartitionByRange(F.desc("units"), "path").sortWithinPartitions(F.desc("units"), "path")
    held = stored(ranges.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "file-ranges")
    counts = held.groupBy("units", "range").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy(F.desc("units"), "range").collect()
    classes, starts = {}, []
    for r in counts:
        before = classes.get(r["units"], 0)
        starts.append((r["units"], r["range"], before + 1 - r["first"]))
        classes[r["units"]] = before + r["n"]
    fitted: dict[int, list[tuple]] = {}
    for size, *span in first_fit(sorted(classes.items(), reverse=True)):
        fitted.setdefault(size, []).append(tuple(span))
    plan = spark.createDataFrame(starts, "units int, range int, shift long")
    ranked = held.join(plan, ["units", "range"]).withColumn("rank", F.col("at") + F.col("shift"))
    spans = spark.createDataFrame(list(fitted.items()), "units int, spans array<struct<first:long,last:long,bin:long,each:long>>")
    span = F.filter("spans", lambda x: (x["first"] <= F.col("rank")) & (F.col("rank") <= x["last"]))[0]
    found = ranked.join(spans, "units").withColumn("s", span)
    return found.select("path", "length", (F.col("s.bin") + F.floor((F.col("rank") - F.col("s.first")) / F.col("s.each"))).cast("int").alias("bin"))


def read_packed(spark: SparkSession, root: str, most_bytes: int = 128 << 20, pattern: str = "*.[xX][mM][lL]") -> DataFrame:
    """SRC-1. ``read_filings`` with one partition for each bin of ``pack_files``, so that tasks parse alike many bytes however sizes are spread."""
    packed = pack_files(listing(spark, root, pattern), most_bytes).select("path", "bin")
    n = (packed.agg(F.max("bin")).first()[0] or 0) + 1
    return read_filings(spark, root, pattern=pattern).join(packed, "path").repartitionById(n, F.col("bin")).select("path", "content")


def read_lookup(spark: SparkSession, path: str) -> Dict:
    """SRC-8. A dictionary's JSON document as tables; the schema is given, so no field becomes a column."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", LOOKUP).alias("d"))
    fields = whole.select(F.explode("d.fields").alias("canonical_name", "f")).select("canonical_name", "f.*")
    index = whole.select(F.explode("d.xpath_index").alias("xpath", "canonical_name"))
    return Dict(fields, xpaths_of(fields), index)


def xpaths_of(fields: DataFrame) -> DataFrame:
    return fields.select("canonical_name", F.explode("xpaths").alias("version", "xpath"))


def versions_of(d: Dict) -> DataFrame:
    """SRC-8. The distinct versions of a dictionary."""
    return d.field_xpaths.select("version").distinct()


def schedules_of(d: Dict) -> DataFrame:
    """SRC-8. The distinct schedules of a dictionary."""
    return d.fields.select("schedule").distinct()


def _optional(spark: SparkSession, path: str | None, name: str, value: T.DataType | str, schema: str, columns: list[Column | str]) -> DataFrame:
    """SRC-9. A JSON object under ``name`` (or at the top) as rows; no path, no rows."""
    if not path:
        return spark.createDataFrame([], schema)
    inner = value if isinstance(value, str) else value.simpleString()
    text = spark.read.text(path, wholetext=True)
    found = text.select(F.coalesce(F.from_json("value", f"{name} map<string,{inner}>")[name], F.from_json("value", f"map<string,{inner}>")).alias("m"))
    return found.select(F.explode("m").alias("canonical_name", "v")).select(*columns)


def read_frequency(spark: SparkSession, path: str | None) -> DataFrame:
    """SRC-9. Field frequencies; empty when there is no file."""
    inner = "struct<present_count:bigint,present_pct:double,nontrivial_count:bigint,nontrivial_pct:double>"
    return _optional(spark, path, "fields", inner, FREQUENCY, ["canonical_name", "v.*"])


def read_categories(spark: SparkSession, path: str | None) -> DataFrame:
    """SRC-9. Category paths of fields; empty when there is no file."""
    return _optional(spark, path, "field_categories", "array<array<string>>", CATEGORIES, ["canonical_name", F.col("v").alias("paths")])


def read_exports(spark: SparkSession, root: str) -> DataFrame:
    """SRC-10. One row per field of a directory's field-set exports; the first file in order that has it wins, the names of all stay."""
    rows = spark.read.schema(EXPORT).option("multiLine", True).option("pathGlobFilter", "*.json").json(root)
    each = rows.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.posexplode("fields").alias("pos", "f"))
    return merge_exports(each.select("file", "pos", "f.*"))


def merge_exports(rows: DataFrame) -> DataFrame:
    """SRC-10. Of (file, pos, field_name, ..) the first row of each field, with ``sources``: the sorted files that name it."""
    others = [c for c in rows.columns if c not in ("field_name", "file", "pos")]
    first = F.min_by(F.struct(*others), F.struct("file", "pos")).alias("f")
    found = rows.where(F.coalesce("field_name", F.lit("")) != "").groupBy("field_name").agg(first, F.array_sort(F.collect_set("file")).alias("sources"), F.min(F.struct("file", "pos")).alias("ord"))
    return found.select("field_name", "f.*", "sources", "ord")
