"""Flat tables out of filings: one row per filing, one table per repeating group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import joined, older_name, segments
from filing_jobs.functions.tables import OLDER_NAMES
from filing_jobs.operators.resolve import resolve_paths
from filing_jobs.operators.specs import scalars_of, spec_xpaths
from filing_jobs.sources.shred import first_texts, texts_and_boxes
from filing_jobs.store import stored

HEADER = ["ein", "tax_period", "org_name", "return_version", "form_type"]
#: Versions are a filer's free text; a table by version is broadcast only if it has at most so many rows.
MANY = 10_000


def names_of(specs: DataFrame) -> list[str]:
    """The field names in order: dictionary-sized."""
    return [r["field_name"] for r in specs.select("field_name", "ord").orderBy("ord", "field_name").collect()]


def usable(headers: DataFrame) -> DataFrame:
    return headers.where("status = 'ok'")


def by_version(headers: DataFrame, xpaths: DataFrame) -> DataFrame:
    """(version, paths: map field -> xpath) for the versions that occur."""
    resolved = resolve_paths(xpaths, headers.select(F.col("return_version").alias("version")))
    return resolved.groupBy("version").agg(F.map_from_entries(F.collect_list(F.struct("field", "xpath"))).alias("paths"))


def for_versions(df: DataFrame) -> DataFrame:
    """A table by version, broadcast if it is small."""
    held = stored(df, "by-version")
    return F.broadcast(held) if held.count() <= MANY else held


def scalars_of_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """EXT-5 from stored rows of first texts."""
    paths = for_versions(by_version(rows.select("return_version").distinct(), spec_xpaths(chosen)))
    found = rows.join(paths, F.col("return_version") == F.col("version"), "left")
    return found.select("path", *HEADER, *(F.coalesce(F.col("texts")[F.col("paths")[name]], F.lit("")).alias(name) for name in names_of(chosen)))


def scalars_of_filings(filings: DataFrame, specs: DataFrame, **columns: str) -> DataFrame:
    """EXT-5. One row per usable filing, one column per scalar field; "" where a filing lacks it.

    Parses each filing once, without a shuffle of the filings: every filing's row holds its own first
    texts, is stored, and the paths of the versions that occur are joined to it.
    """
    chosen = stored(scalars_of(specs), "specs")
    wanted = [r["xpath"] for r in spec_xpaths(chosen).select("xpath").distinct().collect()]  # dictionary-sized
    return scalars_of_rows(stored(usable(first_texts(filings, wanted, **columns)), "first-texts"), chosen)


def tables_of_filings(filings: DataFrame, specs: DataFrame, **columns: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """EXT-5, EXT-6. The scalar table and one table per group, of one pass over the filings and without a shuffle of them.

    A group's table has path, ein, tax_period, instance_num (in document order) and one column per field, "" where missing.
    The instances of all groups are written once, a folder for each group, and each table reads its own folder.
    """
    specs = stored(specs, "specs")  # a dictionary's fields: read several times below
    chosen, grouped = scalars_of(specs), specs.where("group_name != ''")
    wanted = [r["xpath"] for r in spec_xpaths(chosen).select("xpath").distinct().collect()]  # dictionary-sized, as are the next ones
    possible = possible_children(grouped).collect()
    rows = stored(usable(texts_and_boxes(filings, wanted, {r["container"] for r in possible}, {r["child"] for r in possible}, **columns)), "extracted")
    members = grouped.select("group_name", "field_name", "ord").orderBy("ord", "field_name").collect()
    out = {}
    if members:
        held = stored(group_rows(rows, grouped), "group-rows", by="group_name")
        for group in dict.fromkeys(r["group_name"] for r in members):
            names = [r["field_name"] for r in members if r["group_name"] == group]
            out[group] = held.where(F.col("group_name") == group).select("path", "ein", "tax_period", "instance_num", *(F.coalesce(F.col("texts")[n], F.lit("")).alias(n) for n in names))
    return scalars_of_rows(rows, chosen), out


def group_rows(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """EXT-6. (path, ein, tax_period, instance_num, texts: map field -> text, group_name): every instance of every group, in one pass over stored rows."""
    containers, children = group_paths(rows, grouped)
    kids = children.groupBy("group_name", "return_version").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "child"))).alias("kids"))
    own = F.struct("group_name", "container", "kids")
    paths = containers.join(kids, ["group_name", "return_version"], "left").groupBy(F.col("return_version").alias("version")).agg(F.collect_list(own).alias("groups"))  # as many as the dictionary has
    found = rows.join(for_versions(paths), F.col("return_version") == F.col("version"))
    each = found.select("path", "ein", "tax_period", "groups", F.explode("boxes").alias("box"))
    each = each.select("path", "ein", "tax_period", "box", F.explode(F.filter("groups", lambda g: g["container"] == F.col("box.container"))).alias("g"))
    texts = F.map_filter(F.transform_values("g.kids", lambda _, child: F.col("box.texts")[child]), lambda _, text: text.isNotNull())
    return each.select("path", "ein", "tax_period", F.col("box.number").alias("instance_num"), texts.alias("texts"), F.col("g.group_name").alias("group_name"))


def resolved_for(headers: DataFrame, specs: DataFrame) -> DataFrame:
    return resolve_paths(spec_xpaths(specs), headers.select(F.col("return_version").alias("version")))


def scalars(headers: DataFrame, elements: DataFrame, specs: DataFrame) -> DataFrame:
    """EXT-5. As ``scalars_of_filings``, from tables that are shredded already: one pivot by filing."""
    chosen = scalars_of(specs)
    names, heads = names_of(chosen), usable(headers)
    wanted = resolved_for(heads, chosen).select(F.col("version").alias("return_version"), "xpath", "field")
    found = elements.where("section = 'data' and in_root_ns and status = 'ok'").join(for_versions(wanted), ["return_version", "xpath"])
    wide = found.groupBy("path").pivot("field", names).agg(F.min_by("text", "doc_ord")) if names else found.select("path").distinct()
    return heads.join(wide, "path", "left").select("path", *HEADER, *(F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names))


def upto_group(xpath: Column, group: Column) -> Column:
    """The path cut after the first name that is the group's; the whole path if none is."""
    parts = segments(xpath)
    at = F.array_position(parts, group).cast("int")
    return F.when(at > 0, F.concat(F.lit("/"), joined(parts, 1, at))).otherwise(F.concat(F.lit("/"), F.array_join(parts, "/")))


def child_of(container: Column, xpath: Column, relative: Column) -> Column:
    """A field's path in a container: its own if that is below, else by its relative path."""
    below = F.when(xpath.startswith(F.concat(container, F.lit("/"))), F.substring(xpath, F.length(container) + 2, F.length(xpath))).otherwise(relative)
    return F.concat(container, F.lit("/"), below)


def first_members(members: DataFrame) -> DataFrame:
    """The field of each group whose path names the container."""
    return members.groupBy("group_name").agg(F.min_by("field_name", F.struct("ord", "field_name")).alias("field_name"))


def members_of(grouped: DataFrame) -> DataFrame:
    return grouped.select("field_name", "group_name", "relative_xpath", "ord")


def possible_children(grouped: DataFrame) -> DataFrame:
    """(container, child): all that groups can have in whatever version, for every combination of a group's own paths."""
    members = members_of(grouped)
    xpaths = spec_xpaths(grouped).select(F.col("canonical_name").alias("field_name"), "xpath").distinct().join(members, "field_name")
    containers = xpaths.join(first_members(members), ["group_name", "field_name"]).select("group_name", upto_group(F.col("xpath"), F.col("group_name")).alias("container")).distinct()
    return xpaths.join(containers, "group_name").select("container", child_of(F.col("container"), F.col("xpath"), F.col("relative_xpath")).alias("child")).distinct()


def group_paths(headers: DataFrame, grouped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group_name, return_version, container) and (.., field_name, child) for the versions that occur."""
    members = members_of(grouped)
    resolved = stored(resolved_for(headers, grouped).withColumnRenamed("field", "field_name").join(members, "field_name"), "resolved")
    first = resolved.join(first_members(members), ["group_name", "field_name"])
    containers = first.select("group_name", F.col("version").alias("return_version"), upto_group(F.col("xpath"), F.col("group_name")).alias("container"))
    children = resolved.withColumnRenamed("version", "return_version").join(containers, ["group_name", "return_version"])
    children = children.withColumn("child", child_of(F.col("container"), F.col("xpath"), F.col("relative_xpath")))
    return containers, children.select("group_name", "return_version", "container", "field_name", "child").where("child != concat(container, '/')")


def group_values(headers: DataFrame, elements: DataFrame, specs: DataFrame) -> DataFrame:
    """EXT-6. (path, group_name, instance_num, field, text): every group instance with the fields it has.

    An instance without any field still has a row, with a null field. Instances are numbered per filing
    and group in document order.
    """
    containers, children = map(for_versions, group_paths(usable(headers), specs.where("group_name != ''")))

    own = elements.where("section = 'data' and in_root_ns and status = 'ok'")
    boxes = own.join(containers, (own["xpath"] == containers["container"]) & (own["return_version"] == containers["return_version"]))
    order = Window.partitionBy("path", "group_name").orderBy("doc_ord")
    instances = boxes.select("path", "group_name", "doc_ord", F.row_number().over(order).alias("instance_num"))
    values = own.join(children.withColumnRenamed("return_version", "v"), (F.col("xpath") == F.col("child")) & (F.col("return_version") == F.col("v")))
    box = F.element_at(F.filter("anc", lambda a: a["xpath"] == F.col("container")), -1)["ord"]
    values = values.select("path", "group_name", box.alias("box"), "field_name", "text", F.col("doc_ord").alias("at"))
    firsts = values.groupBy("path", "group_name", "box", "field_name").agg(F.min_by("text", "at").alias("text"))
    return instances.withColumnRenamed("doc_ord", "box").join(firsts, ["path", "group_name", "box"], "left").select("path", "group_name", "instance_num", F.col("field_name").alias("field"), "text")


def groups(headers: DataFrame, elements: DataFrame, specs: DataFrame) -> dict[str, DataFrame]:
    """EXT-6. A table per group: path, ein, tax_period, instance_num and one column per field, "" where missing."""
    values = group_values(headers, elements, specs)
    members = specs.where("group_name != ''").select("group_name", "field_name", "ord").orderBy("ord", "field_name").collect()
    out = {}
    for group in dict.fromkeys(r["group_name"] for r in members):
        names = [r["field_name"] for r in members if r["group_name"] == group]
        wide = values.where(F.col("group_name") == group).groupBy("path", "instance_num").pivot("field", names).agg(F.first("text"))
        out[group] = wide.join(usable(headers).select("path", "ein", "tax_period"), "path").select("path", "ein", "tax_period", "instance_num", *(F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names))
    return out


def group_counts(values: DataFrame) -> DataFrame:
    """EXT-7. Instances per group over the corpus."""
    return values.groupBy("group_name").agg(F.count_distinct("path", "instance_num").alias("instances"))


#: EXT-9. Ready-made questions: column -> the paths that may hold it, the first with a text wins. Paths also count with
#: their leaf's older name, and those of the forms before 2013 stand after the newer ones.
PRESETS = {
    "organisations": {"total_revenue": ["/IRS990/CYTotalRevenueAmt", "/IRS990/TotalRevenueAmt", "/IRS990EZ/TotalRevenueAmt", "/IRS990PF/TotalRevenueAmt"]},
    "revenue_and_expenses": {"revenue": ["/IRS990/CYTotalRevenueAmt", "/IRS990/TotalRevenueAmt", "/IRS990EZ/TotalRevenueAmt", "/IRS990/TotalRevenueCurrentYear", "/IRS990EZ/TotalRevenue"], "expenses": ["/IRS990/CYTotalExpensesAmt", "/IRS990/TotalExpensesAmt", "/IRS990EZ/TotalExpensesAmt", "/IRS990/TotalExpensesCurrentYear", "/IRS990EZ/TotalExpenses"]},
    "officer_pay": {"officer_pay": ["/IRS990ScheduleJ/BsCmpnstnFlngOrgAmt", "/IRS990ScheduleJ/BaseCompensationFilingOrgAmt"]},
    "public_support": {"public_support": ["/IRS990ScheduleA/PublicSupportTotal170Amt", "/IRS990ScheduleA/PublicSupportTotal509Amt", "/IRS990ScheduleA/PublicSupportTotal170"]},
    "net_assets": {"net_assets": ["/IRS990/NetAssetsOrFundBalancesEOYAmt", "/IRS990EZ/NetAssetsOrFundBalancesGrp/EOYAmt", "/IRS990/NetAssetsOrFundBalancesEOY"]},
}
#: EXT-9. Officers: the groups that list them, and in each the names of a person, a title and the pay.
OFFICERS = {
    "/IRS990/Form990PartVIISectionAGrp": ("PersonNm", "TitleTxt", "ReportableCompFromOrgAmt"),
    "/IRS990/Form990PartVIISectionA": ("NamePerson", "Title", "ReportableCompFromOrganization"),
    "/IRS990EZ/OfficerDirectorTrusteeEmplGrp": ("PersonNm", "TitleTxt", "CompensationAmt"),
    "/IRS990PF/OfficerDirTrstKeyEmplInfoGrp/OfficerDirTrstKeyEmplGrp": ("PersonNm", "TitleTxt", "CompensationAmt"),
}


def with_older_names(xpaths: DataFrame) -> DataFrame:
    """EXT-9. (.., xpath) rows and those with the leaf's older name."""
    older = older_name(F.substring_index("xpath", "/", -1))
    aliases = xpaths.where(older.isNotNull()).withColumn("xpath", F.concat(F.regexp_replace("xpath", "[^/]*$", ""), older))
    return xpaths.unionByName(aliases).distinct()


def older_path(xpath: str) -> list[str]:
    """The path with its leaf's older name, if it has one."""
    above, _, leaf = xpath.rpartition("/")
    return [f"{above}/{OLDER_NAMES[leaf]}"] if leaf in OLDER_NAMES else []


def preset(filings: DataFrame, name: str, **columns: str) -> DataFrame:
    """EXT-9. Headers and the columns of a ready-made question, for every usable filing; "" where nothing is found."""
    asked = {c: [q for p in paths for q in (p, *older_path(p))] for c, paths in PRESETS[name].items()}
    rows = usable(first_texts(filings, {p for paths in asked.values() for p in paths}, **columns))
    return rows.select("path", *HEADER, *(F.coalesce(*(F.nullif(F.col("texts")[p], F.lit("")) for p in paths), F.lit("")).alias(c) for c, paths in asked.items()))


def officers(filings: DataFrame, **columns: str) -> DataFrame:
    """EXT-9. (path, ein, tax_period, number, person, title, pay): everyone that a filing lists, by name and with pay.

    In order of the document, numbered in each group; a business that is listed has its name's first line; "" where nothing is found.
    """
    business = ["BusinessName/BusinessNameLine1Txt", "BusinessName/BusinessNameLine1"]
    paths = {box: {"person": [person, *business], "title": [title], "pay": [pay]} for box, (person, title, pay) in OFFICERS.items()}
    members = {f"{box}/{m}" for box, fields in paths.items() for names in fields.values() for m in names}
    rows = usable(texts_and_boxes(filings, (), set(OFFICERS), members, **columns))
    each = rows.select("path", "ein", "tax_period", F.explode("boxes").alias("b"))
    value = lambda c: F.coalesce(*(F.nullif(F.col("b.texts")[f"{box}/{m}"], F.lit("")) for box, fields in paths.items() for m in fields[c]), F.lit("")).alias(c)
    return each.select("path", "ein", "tax_period", F.col("b.container").alias("listed_in"), F.col("b.number").alias("number"), value("person"), value("title"), value("pay"))
