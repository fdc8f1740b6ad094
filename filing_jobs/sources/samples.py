"""Filings, a dictionary and schema elements derived from order tables, to run and test the jobs on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_jobs.sources.io import Dict, xpaths_of

#: Schema version by order year.
VERSIONS = {1995: "2013v3.0", 1996: "2014v5.0", 1997: "2016v3.0", 1998: "2018v3.1", 1999: "2020v4.2", 2000: "2022v5.0", 2001: "2024v5.0"}
#: Versions with the older element names.
OLDER = ("2013v3.0", "2014v5.0")
#: What the sample dictionary covers.
COVERED = ["2013v3.0", "2016v3.0", "2018v3.1", "2020v4.2", "2022v5.0"]
PART_VERSIONS = ["2016v3.0", "2018v3.1", "2020v4.2", "2022v5.0", "2022v10.0"]


def tag(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content string): one XML document per order, its lines as instances of a repeating group.

    Every 97th is cut off, of others every 89th has no header, of others every 83rd no data.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").join(spark.read.parquet(f"{sf_dir}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    city = F.when(F.year("o_orderdate").isin(1995, 1996), tag("City", F.col("l_suppkey").cast("string"))).otherwise(tag("CityNm", F.col("l_suppkey").cast("string")))
    group = tag("ContractorCompensationGrp", F.concat(tag("CompensationAmt", F.col("l_quantity").cast("int").cast("string")), tag("ServicesDesc", F.col("l_returnflag")), tag("ContractorAddress", tag("USAddress", city)), tag("StartDt", F.date_format("l_shipdate", "yyyy-MM-dd"))))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    grouped = lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, group.alias("xml")))), lambda x: x["xml"]), "").alias("lines"))

    key = F.col("o_orderkey")
    version = F.create_map(*(F.lit(x) for pair in VERSIONS.items() for x in pair))[F.year("o_orderdate")]
    form = F.when(F.col("o_orderpriority").startswith("1"), "EZ").when(F.col("o_orderpriority").startswith("2"), "PF").otherwise("")
    revenue = tag("TotalRevenueAmt", (F.floor("o_totalprice") + 1).cast("string"))
    pay = F.when(F.col("o_orderstatus") == "P", "").when((F.col("o_orderstatus") == "F") & (key % 10 == 0), "0").otherwise(F.floor("o_totalprice").cast("string"))
    name = F.when(F.year("o_orderdate").isin(1995, 1996), F.lit("BaseCompensationFilingOrgAmt")).otherwise(F.lit("BsCmpnstnFlngOrgAmt"))
    schedule = F.when(F.col("o_orderstatus") != "O", tag("IRS990ScheduleJ", F.concat(F.lit("<"), name, F.lit(">"), pay, F.lit("</"), name, F.lit(">")))).otherwise("")
    unlisted = F.when(key % 7 == 0, tag("UnlistedThingAmt", key.cast("string"))).otherwise("")
    main = tag("IRS990", F.concat(F.when(form == "", revenue).otherwise(""), unlisted, F.coalesce("lines", F.lit(""))))
    other = F.when(form != "", F.concat(F.lit("<IRS990"), form, F.lit(">"), revenue, F.lit("</IRS990"), form, F.lit(">"))).otherwise("")
    header = tag("ReturnHeader", F.concat(tag("TaxPeriodEndDt", F.date_format("o_orderdate", "yyyy-MM-dd")), tag("ReturnTypeCd", F.concat(F.lit("990"), form)), tag("Filer", F.concat(tag("EIN", F.lpad(F.col("o_custkey").cast("string"), 9, "0")), tag("BusinessName", tag("BusinessNameLine1Txt", F.col("c_name")))))))
    bare = (key % 97 != 0) & (key % 89 == 0)
    empty = (key % 97 != 0) & ~bare & (key % 83 == 0)
    whole = F.concat(F.lit('<Return xmlns="http://www.irs.gov/efile" returnVersion="'), version, F.lit('">'), F.when(bare, "").otherwise(header), F.when(empty, "").otherwise(tag("ReturnData", F.concat(main, other, schedule))), F.lit("</Return>"))
    text = F.when(key % 97 == 0, F.expr("substring(w, 1, length(w) - 9)")).otherwise(F.col("w"))
    rows = orders.join(grouped, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("w", whole)
    return rows.select(F.concat(F.lpad(key.cast("string"), 10, "0"), F.lit(".xml")).alias("path"), text.alias("content"))


def _everywhere(xpath: str, older: str | None = None) -> dict[str, str]:
    return {v: older if older and v in OLDER else xpath for v in COVERED}


#: The sample dictionary: name, schedule, type, group, path by version. Two fields occur in no filing.
SAMPLE_FIELDS = [
    ("IRS990_TotalRevenueAmt", "IRS990", "USAmountType", "", _everywhere("/IRS990/TotalRevenueAmt")),
    ("IRS990EZ_TotalRevenueAmt", "IRS990EZ", "USAmountType", "", _everywhere("/IRS990EZ/TotalRevenueAmt")),
    ("BsCmpnstnFlngOrgAmt", "IRS990ScheduleJ", "USAmountType", "", _everywhere("/IRS990ScheduleJ/BsCmpnstnFlngOrgAmt", "/IRS990ScheduleJ/BaseCompensationFilingOrgAmt")),
    ("ContractorCompensationGrp", "IRS990", "(group)", "", _everywhere("/IRS990/ContractorCompensationGrp")),
    ("ContractorCompensationGrp_CompensationAmt", "IRS990", "USAmountType", "ContractorCompensationGrp", _everywhere("/IRS990/ContractorCompensationGrp/CompensationAmt")),
    ("ContractorCompensationGrp_ContractorAddress_USAddress_CityNm", "IRS990", "CityType", "ContractorCompensationGrp", _everywhere("/IRS990/ContractorCompensationGrp/ContractorAddress/USAddress/CityNm", "/IRS990/ContractorCompensationGrp/ContractorAddress/USAddress/City")),
    ("ContractorCompensationGrp_ServicesDesc", "IRS990", "ShortDescriptionType", "ContractorCompensationGrp", _everywhere("/IRS990/ContractorCompensationGrp/ServicesDesc")),
    ("ListedThingAmt", "IRS990", "USAmountType", "", {"2020v4.2": "/IRS990/ListedThingAmt"}),
    ("NeverSeenInd", "IRS990ScheduleB", "BooleanType", "", {"2013v3.0": "/IRS990ScheduleB/NeverSeenInd", "2016v3.0": "/IRS990ScheduleB/NeverSeenInd"}),
]


def dictionary(spark: SparkSession) -> Dict:
    """The sample dictionary, with an index that has older names too."""
    from filing_jobs.operators.dictionary import add_aliases, xpath_index

    rows = [(n, s, n, t, t, f"{n} of {s}", g, bool(g), x, min(x), max(x)) for n, s, t, g, x in SAMPLE_FIELDS]
    from filing_jobs.sources.io import FIELDS

    fields = spark.createDataFrame(rows, FIELDS)
    return Dict(fields, xpaths_of(fields), add_aliases(xpath_index(fields)))


def pascal(text: Column) -> Column:
    return F.regexp_replace(F.initcap(text), " ", "")


def schema_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema elements from parts: odd keys have abbreviated names, a third no documentation."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    letter = F.create_map(*(F.lit(x) for pair in zip(["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"], "ABCDEF", strict=True) for x in pair))[F.col("p_type")]
    whole = pascal(F.col("p_name"))
    name = F.concat(F.when(F.col("p_partkey") % 2 == 1, F.regexp_replace(whole, "[aeiou]", "")).otherwise(whole), F.lit("Amt"))
    group = F.concat(F.lit("Brand"), (F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 5).cast("string"), F.lit("Grp"))
    kind = F.get(F.array(F.lit("USAmountType"), F.lit("efile:IntegerType"), F.lit("(group)")), (F.col("p_partkey") % 3).cast("int"))
    version = F.get(F.array(*(F.lit(v) for v in PART_VERSIONS)), F.col("p_size") % 5)
    rows = part.select(F.concat(F.lit("IRS990Schedule"), letter).alias("schedule"), group.alias("parent_group"), name.alias("element_name"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_name")).alias("documentation"), version.alias("version"), kind.alias("xsd_type"), F.col("p_partkey").alias("seq"))
    return rows.select(F.concat_ws("/", F.lit(""), "schedule", "parent_group", "element_name").alias("xpath"), "element_name", "xsd_type", "documentation", "parent_group", F.lit(True).alias("is_repeating"), F.lit("0").alias("min_occurs"), F.lit("1").alias("max_occurs"), "schedule", "version", "seq")


def schema_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, path, content): one schema file per version and schedule, with the elements of ``schema_elements``.

    Each group is a repeating element of a named type; leaves of one name and group occur once per file.
    """
    rows = schema_elements(spark, sf_dir).where("xsd_type != '(group)'")
    leaves = rows.groupBy("version", "schedule", "parent_group", "element_name").agg(F.min_by(F.struct("xsd_type", "documentation"), "seq").alias("e"))
    leaf = F.concat(F.lit('<xs:element name="'), "element_name", F.lit('" type="'), F.col("e.xsd_type"), F.lit('"><xs:annotation><xs:documentation>'), F.col("e.documentation"), F.lit("</xs:documentation></xs:annotation></xs:element>"))
    types = leaves.groupBy("version", "schedule", "parent_group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("element_name", leaf.alias("x")))), lambda x: x["x"]), "").alias("leaves"))
    named = F.concat(F.lit('<xs:complexType name="'), "parent_group", F.lit('Type"><xs:sequence>'), "leaves", F.lit("</xs:sequence></xs:complexType>"))
    use = F.concat(F.lit('<xs:element name="'), "parent_group", F.lit('" type="t:'), "parent_group", F.lit('Type" maxOccurs="unbounded"/>'))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("parent_group", c.alias("x")))), lambda x: x["x"]), "")
    files = types.groupBy("version", "schedule").agg(listed(named).alias("types"), listed(use).alias("uses"))
    text = F.concat(F.lit('<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:t="urn:t"><xs:element name="'), "schedule", F.lit('"><xs:complexType><xs:sequence>'), "uses", F.lit("</xs:sequence></xs:complexType></xs:element>"), "types", F.lit("</xs:schema>"))
    return files.select("version", F.concat("version", F.lit("/"), "schedule", F.lit(".xsd")).alias("path"), F.encode(text, "utf-8").alias("content"))


def shared_schema_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, path, content): the elements of ``schema_documents`` with shared types, and a file of types for each version.

    The types of groups extend one type (those of even brands by a restriction) that the file of types has, and refer to a named group of it; leaves of type
    IntegerType have simple content; each form also holds a chain of a type that contains itself.
    """
    rows = schema_elements(spark, sf_dir).where("xsd_type != '(group)'")
    leaves = rows.groupBy("version", "schedule", "parent_group", "element_name").agg(F.min_by(F.struct("xsd_type", "documentation"), "seq").alias("e"))
    note = F.concat(F.lit("<xs:annotation><xs:documentation>"), F.col("e.documentation"), F.lit("</xs:documentation></xs:annotation>"))
    simple = F.concat(F.lit('">'), note, F.lit('<xs:complexType><xs:simpleContent><xs:extension base="efile:IntegerType"/></xs:simpleContent></xs:complexType></xs:element>'))
    plain = F.concat(F.lit('" type="'), F.col("e.xsd_type"), F.lit('">'), note, F.lit("</xs:element>"))
    leaf = F.concat(F.lit('<xs:element name="'), "element_name", F.when(F.col("e.xsd_type") == "efile:IntegerType", simple).otherwise(plain))
    listed = lambda key, c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, c.alias("x")))), lambda x: x["x"]), "")
    types = leaves.groupBy("version", "schedule", "parent_group").agg(listed("element_name", leaf).alias("leaves"))
    how = F.when(F.col("parent_group").isin("Brand0Grp", "Brand2Grp", "Brand4Grp"), "restriction").otherwise("extension")
    named = F.concat(F.lit('<xs:complexType name="'), "parent_group", F.lit('Type"><xs:complexContent><xs:'), how, F.lit(' base="t:BaseType"><xs:choice>'), "leaves", F.lit('</xs:choice><xs:group ref="t:NoteGroup"/></xs:'), how, F.lit("></xs:complexContent></xs:complexType>"))
    use = F.concat(F.lit('<xs:element name="'), "parent_group", F.lit('" type="t:'), "parent_group", F.lit('Type" maxOccurs="unbounded"/>'))
    files = types.groupBy("version", "schedule").agg(listed("parent_group", named).alias("types"), listed("parent_group", use).alias("uses"))
    head = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:t="urn:t">'
    form = F.concat(F.lit(f'{head}<xs:element name="'), "schedule", F.lit('"><xs:complexType><xs:sequence>'), "uses", F.lit('<xs:element name="Chain" type="t:ChainType"/></xs:sequence></xs:complexType></xs:element>'), "types", F.lit("</xs:schema>"))
    shared = head + (
        '<xs:complexType name="RootType"><xs:sequence><xs:element name="BaseId" type="t:IdType"/></xs:sequence></xs:complexType>'
        '<xs:complexType name="BaseType"><xs:complexContent><xs:extension base="t:RootType"/></xs:complexContent></xs:complexType>'
        '<xs:group name="NoteGroup"><xs:sequence><xs:element name="NoteTxt" type="t:NoteType" maxOccurs="unbounded"/></xs:sequence></xs:group>'
        '<xs:complexType name="ChainType"><xs:sequence><xs:element name="CodeCd" type="t:CodeType"/><xs:element name="Next" type="t:ChainType" minOccurs="0"/></xs:sequence></xs:complexType></xs:schema>'
    )
    forms = files.select("version", F.concat("version", F.lit("/"), "schedule", F.lit(".xsd")).alias("path"), F.encode(form, "utf-8").alias("content"))
    libraries = files.select("version").distinct().select("version", F.concat("version", F.lit("/Types.xsd")).alias("path"), F.encode(F.lit(shared), "utf-8").alias("content"))
    return forms.unionByName(libraries)


def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frequency per field of the part dictionary: the mean size of the parts of its element name, from parts of even size."""
    e = schema_elements(spark, sf_dir)
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("seq"), "p_size").where("p_size % 2 = 0")
    sizes = e.join(part, "seq").groupBy("xpath").agg(F.sum("p_size").alias("s"), F.count("*").alias("c"))
    return sizes.select("xpath", F.col("c").alias("present_count"), (F.col("s") / F.col("c")).alias("present_pct"), F.lit(0).cast("long").alias("nontrivial_count"), F.lit(0.0).alias("nontrivial_pct"))


def categories(fields: DataFrame) -> DataFrame:
    """Category paths of part fields: by schedule and first letter; fields of group Brand0Grp have none, of Brand1Grp two."""
    first = F.array(F.col("schedule"), F.substring("label", 1, 1))
    paths = F.when(F.col("group") == "Brand0Grp", F.array().cast("array<array<string>>")).when(F.col("group") == "Brand1Grp", F.array(first, F.array(F.lit("Brand")))).otherwise(F.array(F.concat(first, F.array("group"))))
    return fields.select("canonical_name", paths.alias("paths"))


def question_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): filings that answer the ready-made questions, one of each order, under older and newer names; its lines are officers."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    older = F.year("o_orderdate").isin(1995, 1996)
    either = lambda new, old, value: F.when(older, tag(old, value)).otherwise(tag(new, value))
    text = lambda c: F.col(c).cast("string")
    person = F.when(F.col("l_linenumber") == 1, tag("BusinessName", either("BusinessNameLine1Txt", "BusinessNameLine1", F.concat(F.lit("Firm "), text("l_suppkey"))))).otherwise(either("PersonNm", "NamePerson", F.concat(F.lit("Person "), text("l_suppkey"))))
    pay = F.when(F.col("l_returnflag") == "N", "").otherwise(either("ReportableCompFromOrgAmt", "ReportableCompFromOrganization", F.col("l_quantity").cast("int").cast("string")))
    officer = either("Form990PartVIISectionAGrp", "Form990PartVIISectionA", F.concat(person, either("TitleTxt", "Title", F.col("l_linestatus")), pay))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    listed = lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, officer.alias("xml")))), lambda x: x["xml"]), "").alias("officers"))
    price, key = F.floor("o_totalprice").cast("string"), F.col("o_orderkey").cast("string")
    main = F.concat(either("CYTotalRevenueAmt", "TotalRevenueCurrentYear", price), either("CYTotalExpensesAmt", "TotalExpensesCurrentYear", key), F.when(F.col("o_orderstatus") == "O", "").otherwise(either("NetAssetsOrFundBalancesEOYAmt", "NetAssetsOrFundBalancesEOY", price)), F.coalesce("officers", F.lit("")))
    support = F.when(F.col("o_orderstatus") == "F", tag("IRS990ScheduleA", either("PublicSupportTotal170Amt", "PublicSupportTotal170", key))).otherwise("")
    body = F.concat(F.lit("<Return><ReturnHeader>"), tag("Filer", tag("EIN", F.lpad(F.col("o_custkey").cast("string"), 9, "0"))), F.lit("</ReturnHeader><ReturnData>"), tag("IRS990", main), support, F.lit("</ReturnData></Return>"))
    rows = orders.join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(F.concat(F.lpad(key, 10, "0"), F.lit(".xml")).alias("path"), body.alias("content"))
