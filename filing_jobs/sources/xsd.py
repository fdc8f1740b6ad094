"""Schema files: one helper per file gives flat rows; expansion to elements is joins, level by level."""

from __future__ import annotations

import io
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_jobs.functions.tables import FORM_TITLES
from filing_jobs.store import stored

XS = "{http://www.w3.org/2001/XMLSchema}"
MAX_DEPTH, MAX_CONTAINERS = 30, 15
#: Items of a file: elements, and references whose content stands in their place.
ITEMS = "version string, path string, owner string, ord long, kind string, name string, type string, doc string, min_occurs string, max_occurs string, content string, leaf_type string"
NAMED = "version string, name string, file string, pattern string, context string, schedule string, line int"
#: Fixed values. What a schedule's name begins with.
FORM_PREFIXES = ("IRS990", "IRS990EZ", "IRS990PF", "ReturnHeader", "Return")


def schema_files(spark: SparkSession, root: str, version: str | None = None, pattern: str = "*.xsd") -> DataFrame:
    """SRC-11. (version, path, content) of all schema files; the version is the first directory level below ``root``, else ``unknown``.

    With ``version`` only that one; if there is none, files below a directory whose name holds it. Raises if nothing is left.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "content")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    whole = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/")
    below = F.regexp_replace(F.substring("path", len(whole) + 1, 1 << 30), "^/+", "")
    named = files.select(F.when(below.contains("/"), F.substring_index(below, "/", 1)).otherwise("unknown").alias("version"), "path", "content")
    if version is None:
        return named
    chosen = named.where(F.col("version") == version)
    if chosen.isEmpty():
        folders = F.regexp_replace(F.substring("path", len(whole) + 1, 1 << 30), "[^/]*$", "")
        chosen = named.where(folders.contains(version)).withColumn("version", F.lit(version))
        if chosen.isEmpty():
            raise ValueError(f"no schema files of version {version}")
    return chosen


def plain(name: str) -> str:
    return name.split(":", 1)[1] if ":" in name else name


def root_of(content) -> ElementTree.Element | None:
    try:
        return ElementTree.parse(io.BytesIO(bytes(content))).getroot() if content is not None else None
    except (ElementTree.ParseError, ValueError, LookupError):
        return None


def documentation(element: ElementTree.Element) -> str:
    """Texts of the element's own documentation, joined by blanks."""
    found = element.findall(f"{XS}annotation/{XS}documentation")
    texts = [" ".join((d.text or "").split()) for d in found]
    return " ".join(t for t in texts if t)


class FileItems:
    """The items of one file. An owner is a named type, a named group, or a place in the file."""

    def __init__(self, version: str, path: str, root: ElementTree.Element):
        self.version, self.path, self.rows, self.n = version, path, [], 0
        first = next((e.get("name") for e in root if e.tag == f"{XS}element" and e.get("name")), None)
        self.put("file", "schedule", name=first or guessed_schedule(path), content="" if first is None else "element")
        for e in root:
            if e.tag == f"{XS}element":
                self.element(e, f"file:{path}")
        for kind in ("complexType", "group"):
            for e in root.iter(f"{XS}{kind}"):
                if e.get("name"):
                    owner = f"{'type' if kind == 'complexType' else 'group'}:{e.get('name')}"
                    self.put(owner, "named", name=owner)
                    self.children(e, owner, 0)

    def put(self, owner: str, kind: str, **values: str) -> None:
        self.rows.append((self.version, self.path, owner, self.n, kind, *(values.get(c, "") for c in ("name", "type", "doc", "min_occurs", "max_occurs", "content", "leaf_type"))))
        self.n += 1

    def children(self, node: ElementTree.Element, owner: str, depth: int) -> None:
        """Elements in sequences, choices and alls in order; groups and base types as references."""
        if depth > MAX_CONTAINERS:
            return
        for child in node:
            tag = child.tag.removeprefix(XS) if isinstance(child.tag, str) else ""
            if tag == "element":
                self.element(child, owner)
            elif tag in ("sequence", "all", "choice"):
                self.children(child, owner, depth + 1)
            elif tag == "group" and child.get("ref"):
                self.put(owner, "ref", content=f"group:{plain(child.get('ref'))}")
            elif tag == "complexContent":
                for sub in child:
                    if isinstance(sub.tag, str) and sub.tag.removeprefix(XS) in ("extension", "restriction"):
                        if sub.get("base"):
                            self.put(owner, "ref", content=f"type:{plain(sub.get('base'))}")
                        self.children(sub, owner, depth + 1)

    def element(self, e: ElementTree.Element, owner: str) -> None:
        """An element: ``content`` is the owner of what it holds if that is inline, else of its type; empty for a leaf."""
        name = e.get("name") or plain(e.get("ref", ""))
        if not name:
            return
        raw = e.get("type", "")
        values = {"name": name, "type": raw, "doc": documentation(e), "min_occurs": e.get("minOccurs", ""), "max_occurs": e.get("maxOccurs", ""), "leaf_type": raw}
        inline = e.find(f"{XS}complexType")
        if inline is None:
            self.put(owner, "element", **values, content=f"type:{plain(raw)}" if raw else "")
            return
        simple = inline.find(f"{XS}simpleContent")
        if simple is not None:
            parts = [simple.find(f"{XS}extension"), simple.find(f"{XS}restriction")]
            base = next((plain(p.get("base")) for p in parts if p is not None and p.get("base")), "")
            self.put(owner, "element", **values | {"leaf_type": base or raw})
            return
        inner = f"inline:{self.path}:{self.n}"
        self.put(owner, "element", **values, content=inner)
        self.children(inline, inner, 0)


def guessed_schedule(path: str) -> str:
    """The form whose name the file's begins with, the longest first; else the file's name."""
    stem = path.rpartition("/")[2].removesuffix(".xsd")
    for name in sorted(FORM_TITLES, key=len, reverse=True):
        if stem.startswith(name):
            return name
    return "ReturnHeader" if "returnheader" in stem.lower() else stem


def items(files: DataFrame) -> DataFrame:
    """XSD-1. The items of all files; files that don't parse have none."""
    names = [x.split()[0] for x in ITEMS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                root = root_of(row["content"])
                if root is not None:
                    columns = list(zip(*FileItems(row["version"], row["path"], root).rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "ord" else pa.string()) for n, c in zip(names, columns, strict=True)], names)

    return files.select("version", "path", "content").mapInArrow(run, ITEMS)


def resolved(rows: DataFrame) -> DataFrame:
    """XSD-1. (version, reader, owner, ord array, ...): what each owner holds as seen from each file, references replaced.

    A file's own definitions come before others'; of others the one in the last path counts. References
    nest at most MAX_CONTAINERS deep, which also ends cycles.
    """
    named = rows.where("kind = 'named'").groupBy("version", "owner").agg(F.max("path").alias("home"))
    own = rows.where("kind = 'named'").select("version", "owner", F.col("path").alias("reader")).distinct()
    readers = rows.where("kind = 'schedule' and content = 'element'").select("version", F.col("path").alias("reader"))
    home = readers.join(named, "version").join(own.withColumn("mine", F.lit(True)), ["version", "owner", "reader"], "left")
    home = home.select("version", "reader", "owner", F.when(F.col("mine"), F.col("reader")).otherwise(F.col("home")).alias("path"))
    held = rows.where("kind in ('element', 'ref')")
    seen = home.join(held, ["version", "path", "owner"])
    # what stands directly in a file, or inline in it or in a definition that is seen from it
    direct = held.where(F.col("owner").startswith("file:")).join(readers, "version").where("path = reader")
    inline = held.where(F.col("owner").startswith("inline:")).join(readers, "version")
    flat = seen.unionByName(direct).unionByName(inline).withColumn("ords", F.array("ord"))
    done = flat.where("kind = 'element'")
    open_ = flat.where("kind = 'ref'")
    for _ in range(MAX_CONTAINERS):
        if open_.isEmpty():
            break
        inner = seen.select("version", "reader", F.col("owner").alias("target"), *(F.col(c).alias(f"i_{c}") for c in ("ord", "kind", "name", "type", "doc", "min_occurs", "max_occurs", "content", "leaf_type")))
        step = open_.join(inner, (open_["content"] == inner["target"]) & (open_["version"] == inner["version"]) & (open_["reader"] == inner["reader"]))
        step = step.select(open_["version"], "path", "owner", "ord", *(F.col(f"i_{c}").alias(c) for c in ("kind", "name", "type", "doc", "min_occurs", "max_occurs", "content", "leaf_type")), open_["reader"], F.concat("ords", F.array("i_ord")).alias("ords"))
        step = stored(step, "schema-references")
        done = done.unionByName(step.where("kind = 'element'").select(done.columns))
        open_ = step.where("kind = 'ref'")
    return done


#: What is kept of an element of an expansion: the last one on its way.
LAST = ("name", "type", "doc", "min_occurs", "max_occurs", "content", "leaf_type", "complex")


def composed(above: DataFrame, below: DataFrame) -> DataFrame:
    """Ways of ``above`` that end in a complex element, each lengthened by every way of ``below`` that begins in what it holds."""
    keys = ["version", "reader"]
    inner = below.select(*keys, F.col("owner").alias("inside"), *(F.col(c).alias(f"b_{c}") for c in ("names", "walk", "open", "parent", *LAST)))
    ends = above.where("complex").withColumnRenamed("content", "inside")
    met = ends.join(inner, [*keys, "inside"])
    opened = F.col("open") | (F.col("max_occurs") == "unbounded") | F.col("b_open")
    return met.select(*keys, "owner", F.concat("names", "b_names").alias("names"), F.concat("walk", "b_walk").alias("walk"), opened.alias("open"), F.coalesce("b_parent", "name").alias("parent"), *(F.col(f"b_{c}").alias(c) for c in LAST))


def expand(rows: DataFrame) -> DataFrame:
    """XSD-2, XSD-3. Schema elements with their paths, of all files that have a top-level element.

    What an owner holds 2, 4, 8 and 16 levels below is composed of what owners hold half as deep, once for all of
    an owner's uses; the files' own elements are then lengthened by 1, 2, 4, 8 and 16 levels. So the number of jobs follows
    the logarithm of the depth, at most MAX_DEPTH + 1 levels, which ends type cycles. A complex element that repeats,
    or stands below one that does, also gives a ``(group)`` row and names its children's group: of a way it is enough
    to know whether an element above the last one repeats (``open``) and the last one's parent. ``seq`` follows the
    order of files and of the walk.
    """
    rows = stored(rows, "schema-items")
    heads = rows.where("kind = 'schedule' and content = 'element'").select("version", F.col("path").alias("reader"), F.col("name").alias("schedule"))
    held = stored(resolved(rows).select("version", "reader", "owner", "ords", "name", "type", "doc", "min_occurs", "max_occurs", "content", "leaf_type"), "schema-held")
    owners = held.select("version", "reader", F.col("owner").alias("content")).union(rows.where("kind = 'named'").select("version", "owner").distinct().join(heads, "version").select("version", "reader", "owner")).distinct().withColumn("complex", F.lit(True))
    inline = F.col("content").startswith("inline:")
    steps = held.join(owners, ["version", "reader", "content"], "left").withColumn("complex", inline | F.coalesce("complex", F.lit(False)))
    steps = steps.select("version", "reader", "owner", F.array("name").alias("names"), F.array("ords").alias("walk"), F.lit(False).alias("open"), F.lit(None).cast("string").alias("parent"), *LAST)
    steps = stored(steps, "schema-steps")
    found = steps.where(F.col("owner") == F.concat(F.lit("file:"), F.col("reader"))).join(heads.select("version", "reader"), ["version", "reader"], "left_semi")
    deeper, depth = steps.where(~F.col("owner").startswith("file:")), 1
    while depth <= MAX_DEPTH and not deeper.isEmpty():  # found: the first ``depth`` levels; deeper: what is ``depth`` levels below an owner
        found = stored(found.unionByName(composed(found, deeper)).where(F.size("names") <= MAX_DEPTH + 1), "schema-ways")
        depth *= 2
        if depth <= MAX_DEPTH:
            deeper = stored(composed(deeper, deeper), "schema-steps")
    repeats = F.col("open") | (F.col("max_occurs") == "unbounded")
    first = F.when(F.col("names")[0] == F.col("schedule"), "").otherwise(F.concat(F.lit("/"), "schedule"))
    out = found.join(heads, ["version", "reader"]).withColumn("repeats", repeats).where("not complex or repeats")
    return out.select(
        F.concat(first, F.lit("/"), F.array_join("names", "/")).alias("xpath"), F.col("name").alias("element_name"), F.when(F.col("complex"), "(group)").otherwise(F.col("leaf_type")).alias("xsd_type"), F.col("doc").alias("documentation"),
        F.when(F.col("open"), F.col("parent")).otherwise("").alias("parent_group"), F.when(F.col("complex"), True).otherwise(F.col("open")).alias("is_repeating"), "min_occurs", "max_occurs", "schedule", "version", F.struct(F.col("reader").alias("path"), "walk").alias("seq"),
    )


def pattern_of(e: ElementTree.Element) -> str:
    """How an element's content is written."""
    inline = e.find(f"{XS}complexType")
    if inline is None:
        return "simple_typed" if e.get("type") else "untyped"
    for kind in ("simpleContent", "complexContent"):
        content = inline.find(f"{XS}{kind}")
        if content is not None:
            for how in ("extension", "restriction"):
                part = content.find(f"{XS}{how}")
                if part is not None:
                    return f"{kind}/{how}[base={part.get('base', '?')}]"
            return f"{kind}/other"
    tags = [c.tag.rpartition("}")[2] for c in inline if isinstance(c.tag, str)]
    return f"complexType[{'+'.join(tags)}]" if tags else "complexType[empty]"


def schedule_of_context(context: str) -> str:
    """The first part that begins as a form does."""
    for part in context.split("/"):
        clean = part.strip("[]").replace("type:", "").replace("group:", "")
        if clean.startswith(FORM_PREFIXES):
            return clean.partition("[")[0]
    return ""


def named_elements(files: DataFrame) -> DataFrame:
    """VAL-1. Every named element of every schema file: pattern, enclosing names, schedule, line (its place among the file's elements)."""

    def of(version: str, path: str, root: ElementTree.Element) -> Iterator[tuple]:
        stack: list[tuple[ElementTree.Element, tuple[str, ...]]] = [(root, ())]
        number = 0
        while stack:
            e, above = stack.pop()
            if not isinstance(e.tag, str):
                continue
            kind, name = e.tag.rpartition("}")[2], e.get("name", "")
            own = {"element": name, "complexType": f"[type:{name}]", "group": f"[group:{name}]"}.get(kind, "") if name else ""
            parts = (*above, own) if own else above
            if e.tag == f"{XS}element":
                number += 1
                if name:
                    context = "/".join(parts)
                    yield version, name, path.rpartition("/")[2], pattern_of(e), context, schedule_of_context(context), number
            stack.extend((c, parts) for c in reversed(e))

    names = [x.split()[0] for x in NAMED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                root = root_of(row["content"])
                found = list(of(row["version"], row["path"], root)) if root is not None else []
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "line" else pa.string()) for n, c in zip(names, columns, strict=True)], names)

    return files.select("version", "path", "content").mapInArrow(run, NAMED)
