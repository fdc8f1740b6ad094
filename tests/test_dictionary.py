"""Building a dictionary: merge fold, collisions, schema patterns, exports, categories."""

from filing_jobs.operators import browse, categories, dictionary, select, validate
from filing_jobs.sources import io, samples, xsd

ELEMENT = "xpath string, element_name string, xsd_type string, documentation string, parent_group string, is_repeating boolean, min_occurs string, max_occurs string, schedule string, version string, seq long"


def elements(spark, rows):
    return spark.createDataFrame([(x, x.rpartition("/")[2], "T", doc, "", False, "", "", x.split("/")[1], v, k) for k, (x, v, doc) in enumerate(rows)], ELEMENT)


def test_merge_is_a_greedy_fold(spark):
    rows = [("/S/C", "2013v1.0", "same"), ("/S/C", "2015v1.0", "same"), ("/S/A", "2013v1.0", " SAME"), ("/S/B", "2014v1.0", "same")]
    got = {r["xpath"]: r for r in dictionary.merge_renames(dictionary.exact_fields(elements(spark, rows))).collect()}
    assert got["/S/C"]["versions"] == ["2013v1.0", "2014v1.0", "2015v1.0"] and got["/S/C"]["xpaths"]["2014v1.0"] == "/S/B"
    assert got["/S/A"]["versions"] == ["2013v1.0"] and "/S/B" not in got


def test_newest_documentation_and_collisions(spark):
    rows = [("/IRS990/X", "2013v1.0", "old"), ("/IRS990/X", "2014v10.0", ""), ("/IRS990/X", "2014v9.0", "newer"), ("/IRS990EZ/X", "2013v1.0", ""), ("/IRS990/CityNm", "2013v1.0", "c"), ("/IRS990/City", "2013v1.0", "d"), ("/IRS990EZ/G/CityNm", "2013v1.0", "e")]
    d = dictionary.build(elements(spark, rows))
    fields = {r["canonical_name"]: r for r in d.fields.collect()}
    assert fields["IRS990_X"]["description"] == "newer" and fields["IRS990_X"]["version_end"] == "2014v10.0"
    assert fields["IRS990EZ_X"]["description"] == "X (within IRS990EZ)"
    index = {r["xpath"]: r["canonical_name"] for r in d.xpath_index.collect()}
    assert index["/IRS990/City"] == "City" and index["/IRS990EZ/G/City"] == "G_CityNm"
    counts = dictionary.counts(elements(spark, rows), d.fields).first()
    assert (counts["elements"], counts["fields"], counts["repeating"]) == (7, 5, 0)


XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:e="urn:e">
<xs:element name="IRS990"><xs:complexType><xs:sequence>
  <xs:element name="Typed" type="e:IntegerType"><xs:annotation><xs:documentation>a  typed
   leaf</xs:documentation></xs:annotation></xs:element>
  <xs:element name="Simple"><xs:complexType><xs:simpleContent><xs:extension base="e:BooleanType"/></xs:simpleContent></xs:complexType></xs:element>
  <xs:choice><xs:element name="Named" type="BaseType" maxOccurs="unbounded"/><xs:sequence><xs:group ref="e:Shared"/></xs:sequence></xs:choice>
  <xs:element name="Extended"><xs:complexType><xs:complexContent><xs:extension base="Derived"><xs:sequence><xs:element name="Own" type="T"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType></xs:element>
  <xs:element name="Many" type="e:T" maxOccurs="unbounded"/>
  <xs:element ref="e:Referred"/>
  <xs:element name="Loop" type="LoopType"/>
</xs:sequence></xs:complexType></xs:element>
<xs:complexType name="BaseType"><xs:all><xs:element name="B1" type="T"/><xs:element name="Inner"><xs:complexType><xs:sequence><xs:element name="I1" type="T"/></xs:sequence></xs:complexType></xs:element></xs:all></xs:complexType>
<xs:complexType name="LoopType"><xs:sequence><xs:element name="Again" type="LoopType" minOccurs="0"/><xs:element name="End" type="T"/></xs:sequence></xs:complexType>
</xs:schema>"""
LIBRARY = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
<xs:complexType name="Derived"><xs:complexContent><xs:extension base="BaseType"><xs:sequence><xs:element name="D1" type="T"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType>
<xs:complexType name="BaseType"><xs:sequence><xs:element name="Elsewhere" type="T"/></xs:sequence></xs:complexType>
<xs:group name="Shared"><xs:sequence><xs:element name="G1" type="T"/></xs:sequence></xs:group>
</xs:schema>"""


def test_schema_patterns(spark):
    files = spark.createDataFrame([("2020v1.0", "2020v1.0/form.xsd", XSD.encode()), ("2020v1.0", "2020v1.0/types.xsd", LIBRARY.encode()), ("2020v1.0", "2020v1.0/broken.xsd", b"<xs:"), ("2021v1.0", "2021v1.0/none.xsd", None)], "version string, path string, content binary")
    rows = xsd.expand(xsd.items(files)).orderBy("seq").collect()
    got = [(r["xpath"], r["xsd_type"], r["parent_group"], r["is_repeating"]) for r in rows if "Loop" not in r["xpath"]]
    assert got == [
        ("/IRS990/Typed", "e:IntegerType", "", False), ("/IRS990/Simple", "BooleanType", "", False),
        ("/IRS990/Named", "(group)", "", True), ("/IRS990/Named/B1", "T", "Named", True), ("/IRS990/Named/Inner", "(group)", "Named", True), ("/IRS990/Named/Inner/I1", "T", "Inner", True),
        ("/IRS990/G1", "T", "", False), ("/IRS990/Extended/B1", "T", "", False), ("/IRS990/Extended/Inner/I1", "T", "", False), ("/IRS990/Extended/D1", "T", "", False), ("/IRS990/Extended/Own", "T", "", False),
        ("/IRS990/Many", "e:T", "", False), ("/IRS990/Referred", "", "", False),
    ]
    assert rows[0]["documentation"] == "a typed leaf" and rows[0]["schedule"] == "IRS990"
    loops = [r["xpath"] for r in rows if r["xpath"].endswith("/End")]
    assert len(loops) == 29 and max(x.count("/Again") for x in loops) == 28
    named = xsd.named_elements(files)
    by_name = {r["name"]: r for r in validate.dedup(named).collect()}
    assert by_name["Simple"]["pattern"] == "simpleContent/extension[base=e:BooleanType]" and by_name["Extended"]["pattern"] == "complexContent/extension[base=Derived]"
    assert by_name["I1"]["context"] == "[type:BaseType]/Inner/I1" and by_name["I1"]["schedule"] == "" and by_name["Own"]["schedule"] == "IRS990" and by_name["IRS990"]["pattern"] == "complexType[sequence]"


def test_schema_files_by_version(spark, tmp_path):
    for folder in ("2020v1.0", "2021v1.0"):
        (tmp_path / "schemas" / folder).mkdir(parents=True)
        (tmp_path / "schemas" / folder / "IRS990.xsd").write_text(XSD)
    (tmp_path / "schemas" / "flat.xsd").write_text(LIBRARY)
    root = str(tmp_path / "schemas")
    assert sorted(r["version"] for r in xsd.schema_files(spark, root).collect()) == ["2020v1.0", "2021v1.0", "unknown"]
    assert xsd.schema_files(spark, root, "2020v1.0").count() == 1


def test_category_paths(spark):
    fields = spark.createDataFrame([(n,) for n in "abcd"], "canonical_name string")
    cats = spark.createDataFrame([("a", []), ("b", [["A"]]), ("c", [["A", "B", "C"]])], io.CATEGORIES)
    rows = {(r["canonical_name"]): (r["top"], r["sub"]) for r in browse.by_category(fields, cats, spark.createDataFrame([], io.FREQUENCY)).collect()}
    assert rows == {"a": ("Uncategorized", "(General)"), "d": ("Uncategorized", "(General)"), "b": ("A", "(General)"), "c": ("A", "B > C")}
    tree = {tuple(r["path"]): (r["fields"], r["fields_below"]) for r in categories.tree(cats).collect()}
    assert tree == {("A",): (["b"], 2), ("A", "B"): ([], 1), ("A", "B", "C"): (["c"], 1)}


def test_reading_and_writing(spark, tmp_path):
    from filing_jobs.operators import outputs

    d = samples.dictionary(spark)
    outputs.write_table(outputs.lookup_document(d), str(tmp_path / "lookup"), "text")
    back = io.read_lookup(spark, str(tmp_path / "lookup"))
    assert sorted(map(str, back.fields.select(d.fields.columns).collect())) == sorted(map(str, d.fields.collect()))
    assert sorted(back.xpath_index.collect()) == sorted(d.xpath_index.collect()) and io.versions_of(back).count() == 5
    assert io.read_frequency(spark, None).count() == 0 and io.read_categories(spark, None).count() == 0
    (tmp_path / "c.json").write_text('{"field_categories": {"x": [["A", "B"]]}}')
    assert io.read_categories(spark, str(tmp_path / "c.json")).first()["paths"] == [["A", "B"]]
    (tmp_path / "sets").mkdir()
    (tmp_path / "sets" / "a.json").write_text('{"fields": [{"field_name": "F", "label": "one", "xpaths": {"2020v1.0": "/IRS990/XGrp/F"}}]}')
    (tmp_path / "sets" / "b.json").write_text('{"fields": [{"field_name": "F", "label": "two"}, {"field_name": "G"}]}')
    from filing_jobs.operators import specs

    got = {r["field_name"]: r for r in specs.from_exports(spark, str(tmp_path / "sets")).collect()}
    assert got["F"]["label"] == "one" and got["F"]["sources"] == ["a.json", "b.json"] and got["F"]["group_name"] == "XGrp" and got["G"]["group_name"] == ""
    outputs.write_table(outputs.spec_reference(specs.from_exports(spark, str(tmp_path / "sets"))), str(tmp_path / "ref"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "ref")).count() == 2


def test_selection_limits(spark):
    fields = spark.createDataFrame([(f"f{k}", "S" if k < 4 else "R", {"v": "x"}) for k in range(8)], "canonical_name string, schedule string, xpaths map<string,string>")
    cats = spark.createDataFrame([(f"f{k}", [["A", "B"]]) for k in (2, 3, 6)], io.CATEGORIES)
    freq = spark.createDataFrame([(f"f{k}", 1, float(k), 0, 0.0) for k in range(4)], io.FREQUENCY)
    rows = select.candidates(fields, cats, ["S"], ["A"])
    names = lambda df: sorted(r["canonical_name"] for r in df.collect())
    assert names(rows) == ["f0", "f1", "f2", "f3", "f6"]
    assert names(select.limit_overflow(rows, freq, ["S"], ["A"], limit=10)) == names(rows)
    assert names(select.limit_overflow(rows, freq, ["S"], ["A"], limit=4)) == ["f1", "f2", "f3"]
    assert names(select.limit_overflow(rows, freq, ["S"], ["A"], limit=2)) == ["f2", "f3"]
