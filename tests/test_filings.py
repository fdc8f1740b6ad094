"""Shredding and extraction on hand-made filings."""

from collections import Counter

from pyspark.sql import functions as F

from filing_jobs import queries
from filing_jobs.operators import audit, extract, specs
from filing_jobs.plans import workloads
from filing_jobs.sources import io, samples, shred
from filing_jobs.streaming import filings as streaming

FILER = "<Filer><EIN>001234567</EIN><BusinessName><BusinessNameLine1Txt>Some Org</BusinessNameLine1Txt></BusinessName></Filer>"
HEADER = f"<ReturnHeader><TaxPeriodEndDt>2020-12-31</TaxPeriodEndDt><ReturnTypeCd>990</ReturnTypeCd>{FILER}</ReturnHeader>"


def filing(data, header=HEADER, version="2020v4.2", space=' xmlns="http://www.irs.gov/efile"'):
    return f'<Return{space} returnVersion="{version}">{header}{data}</Return>'


GROUP = "<ContractorCompensationGrp>{}</ContractorCompensationGrp>"
DOCS = {
    "a.xml": filing(f"<ReturnData><IRS990><!-- c --><TotalRevenueAmt> 7 </TotalRevenueAmt>{GROUP.format('<CompensationAmt>1</CompensationAmt>')}{GROUP.format('')}{GROUP.format('<CompensationAmt/><CompensationAmt>5</CompensationAmt>')}</IRS990></ReturnData>"),
    "b.xml": filing("<ReturnData><IRS990><TotalRevenueAmt/><TotalRevenueAmt>5</TotalRevenueAmt></IRS990></ReturnData>", space=""),
    "c.xml": filing("<ReturnData/>")[:-3],
    "d.xml": filing("<ReturnData><IRS990/></ReturnData>", header=""),
    "e.xml": filing(""),
    "f.xml": filing('<ReturnData><x:IRS990 xmlns:x="urn:other"><x:TotalRevenueAmt>9</x:TotalRevenueAmt></x:IRS990></ReturnData>'),
    "g.xml": '<!DOCTYPE r [<!ENTITY a "b">]>' + filing("<ReturnData/>"),
    "h.xml": filing("<ReturnData><IRS990EZ/><IRS990/></ReturnData>", header=f"<ReturnHeader><TaxYr>2011</TaxYr><Filer><Name><BusinessNameLine1>Old</BusinessNameLine1></Name></Filer></ReturnHeader>"),
}


def table(spark):
    return spark.createDataFrame([(k, v.encode(), 1) for k, v in DOCS.items()] + [("z.xml", None, 1)], "path string, content binary, xpath int").repartition(3)


def test_headers(spark):
    got = {r["path"]: r for r in shred.headers(table(spark)).collect()}
    status = {k: r["status"] for k, r in got.items()}
    assert status == {"a.xml": "ok", "b.xml": "ok", "c.xml": "malformed", "d.xml": "no_header", "e.xml": "no_data", "f.xml": "ok", "g.xml": "malformed", "h.xml": "ok", "z.xml": "malformed"}
    assert (got["a.xml"]["ein"], got["a.xml"]["org_name"], got["a.xml"]["tax_period"], got["a.xml"]["form_type"]) == ("001234567", "Some Org", "2020-12-31", "990")
    assert (got["h.xml"]["tax_period"], got["h.xml"]["legacy_period"], got["h.xml"]["org_name"], got["h.xml"]["legacy_name"]) == ("", "2011", "", "Old")


def test_elements(spark):
    rows = shred.shred_filings(table(spark)).orderBy("path", "doc_ord").collect()
    assert [(r["xpath"], r["text"]) for r in rows if r["path"] == "b.xml"] == [("/IRS990", ""), ("/IRS990/TotalRevenueAmt", ""), ("/IRS990/TotalRevenueAmt", "5")]
    assert [r["xpath"] for r in rows if r["path"] == "e.xml"][:3] == ["/TaxPeriodEndDt", "/ReturnTypeCd", "/Filer"]
    assert {r["in_root_ns"] for r in rows if r["path"] == "f.xml"} == {False}
    assert not [r for r in rows if r["path"] in ("c.xml", "g.xml", "z.xml")]
    wanted = shred.shred_filings(table(spark), ["/IRS990/TotalRevenueAmt"])
    assert wanted.count() == len([r for r in rows if r["xpath"] == "/IRS990/TotalRevenueAmt"])
    forms = {r["path"]: (r["schedules"], r["form_type"]) for r in shred.forms_present(shred.shred_filings(table(spark))).collect()}
    assert forms["h.xml"] == (["IRS990", "IRS990EZ"], "IRS990")


def all_specs(spark):
    d = samples.dictionary(spark)
    return specs.from_schedule(d, "IRS990").unionByName(specs.from_schedule(d, "IRS990ScheduleJ"))


def test_extraction(spark):
    chosen = all_specs(spark)
    both = [extract.scalars_of_filings(table(spark), chosen), extract.scalars(shred.headers(table(spark)), shred.shred_filings(table(spark)), chosen)]
    for df in both:
        got = {r["path"]: r for r in df.collect()}
        assert set(got) == {"a.xml", "b.xml", "f.xml", "h.xml"}
        assert {k: r["IRS990_TotalRevenueAmt"] for k, r in got.items()} == {"a.xml": "7", "b.xml": "", "f.xml": "", "h.xml": ""}
    scalars, groups = workloads.extract_tables(table(spark), chosen)
    rows = groups["ContractorCompensationGrp"].orderBy("path", "instance_num").collect()
    assert [(r["path"], r["instance_num"], r["ContractorCompensationGrp_CompensationAmt"]) for r in rows] == [("a.xml", 1, "1"), ("a.xml", 2, ""), ("a.xml", 3, "")]


def test_audit_keeps_the_first_text_that_is_not_empty(spark):
    paths = audit.filing_paths(shred.shred_filings(table(spark)))
    got = {(r["path"], r["xpath"]): r["sample"] for r in paths.collect()}
    assert got["b.xml", "/IRS990/TotalRevenueAmt"] == "5"
    found = workloads.audit_corpus(table(spark), samples.dictionary(spark))
    summary = found.summary.first()
    assert summary["filings_audited"] == len(DOCS) + 1 and summary["missing_versions"] == 0
    assert {r["canonical_name"] for r in found.unused.collect()} >= {"ListedThingAmt", "NeverSeenInd"}


def test_partitioning_does_not_matter(spark):
    chosen = all_specs(spark)
    one, seven = (sorted(map(str, extract.scalars_of_filings(table(spark).repartition(n), chosen).collect())) for n in (1, 7))
    assert one == seven


def test_files_lie_there_a_part_at_a_time(spark, monkeypatch):
    listed, own = [], io.read_filings

    def noted(*args, **options):
        found = own(*args, **options)
        listed.append([len(bytes(r["content"])) for r in found.select("content").collect()])
        return found

    monkeypatch.setattr(io, "FILES", 400, raising=False)
    monkeypatch.setattr(io, "read_filings", noted)
    found = queries.src_filing_files(spark, "/root/testdata/sf0.001")
    want = shred.status_counts(shred.headers(samples.filings(spark, "/root/testdata/sf0.001")))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    filled = [sum(n > 0 for n in sizes) for sizes in listed]
    assert sum(filled) == 1500 and len(listed) == 4 and max(filled) <= 450
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    for texts in ([], ["only one"], ["", "\n", "a\nb", "ä\r\n", "a\nb", *map(str, range(900))]):
        rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
        read = io.through_files(rows, lambda files: files.select(F.col("content").cast("string").alias("t")))
        assert Counter(r["t"] for r in read.collect()) == Counter(t + "\n" for t in texts)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for k, v in DOCS.items():
        (tmp_path / "in" / ("deep" if k < "d" else "") / k.replace(".xml", ".XML" if k == "b.xml" else ".xml")).write_text(v)
    (tmp_path / "in" / "note.txt").write_text("no filing")
    assert io.read_filings(spark, str(tmp_path / "in")).count() == len(DOCS)
    limited = io.read_filings(spark, str(tmp_path / "in"), limit=3)
    assert sorted(r["path"].rpartition("/")[2] for r in limited.collect()) == ["a.xml", "b.XML", "d.xml"]  # "d.xml" comes before "deep/"
    query = streaming.append_elements(streaming.arriving_filings(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "headers")).count() == len(DOCS)
    counted = {r["xpath"]: r["filings"] for r in streaming.path_counts(spark.read.parquet(str(tmp_path / "out" / "elements"))).collect()}
    assert counted["/IRS990"] == 5
