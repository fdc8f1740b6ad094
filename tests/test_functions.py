"""Golden rows of the column functions and of the rules that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from filing_jobs.functions import scalars as fn
from filing_jobs.operators.resolve import resolve_paths


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


CASES = [
    (lambda: fn.label(F.lit("BsCmpnstnFlngOrgAmt")), "Bs Compensation Filing Organization Amount"),
    (lambda: fn.label(F.lit("OrgnztnNm")), "Organizationnztn Name"),
    (lambda: fn.canonical_name(F.lit("/IRS990ScheduleJ/CompInfoGrp/TotalAmt")), "CompInfoGrp_TotalAmt"),
    (lambda: fn.canonical_name(F.lit("/IRS990")), "IRS990"),
    (lambda: fn.inferred_description(F.lit("/IRS990/FooGrp/BarAmt"), F.lit("BarAmt")), "Bar Amt (within Foo Grp)"),
    (lambda: fn.inferred_description(F.lit("/BarAmt"), F.lit("BarAmt")), "BarAmt"),
    (lambda: fn.version_key(F.lit("2013v3.0")), (2013, 3, 0)),
    (lambda: fn.version_key(F.lit("2013")), (2013, 0, 0)),
    (lambda: fn.version_key(F.lit("unknown")), (0, 0, 0)),
    (lambda: fn.filing_version_key(F.lit("2020v4.10")), (2020, 50)),
    (lambda: fn.filing_version_key(F.lit("2020")), (0, 0)),
    (lambda: fn.group_of(F.lit("/IRS990/ContractorCompensationGrp/ContractorAddress/USAddress/CityNm")), ("ContractorCompensationGrp", "/IRS990/ContractorCompensationGrp", "ContractorAddress/USAddress/CityNm")),
    (lambda: fn.group_of(F.lit("/IRS990/TotalGrp")), ("", "", "")),
    (lambda: fn.group_of(F.lit("/A/BGrp/CTable/D")), ("CTable", "/A/BGrp/CTable", "D")),
    (lambda: fn.group_of(F.lit("IRS990/XGrp/Y")), ("", "", "")),
    (lambda: fn.group_of(F.lit("")), ("", "", "")),
    (lambda: fn.guessed_type(F.lit("1")), "boolean"),
    (lambda: fn.guessed_type(F.lit("-12")), "integer"),
    (lambda: fn.guessed_type(F.lit("1.5")), "decimal"),
    (lambda: fn.guessed_type(F.lit("2020-01-01T00")), "date"),
    (lambda: fn.guessed_type(F.lit("12-3456789")), "EIN"),
    (lambda: fn.guessed_type(F.lit("")), "unknown"),
    (lambda: fn.guessed_type(F.lit("x" * 51)), "text_long"),
    (lambda: fn.plain_words(F.lit("BsCmpnstnFlngOrgAmt")), "base compensation filing organization amount"),
    (lambda: fn.plain_words(F.lit("BaseCompensationFilingOrgAmt")), "base compensation filing organization amount"),
    (lambda: fn.plain_words(F.lit("IRS990")), "i r s"),
    (lambda: fn.dice(F.lit("night"), F.lit("nacht")), 0.25),
    (lambda: fn.dice(F.lit("a"), F.lit("nacht")), 0.0),
    (lambda: fn.part_score(F.lit("RevenueAmt"), F.lit("CYRevenueAmt"), F.lit(True)), 0.75),
    (lambda: fn.part_score(F.lit("FooTotalAmt"), F.lit("BarxTotalAmt"), F.lit(False)), 0.45),
    (lambda: fn.nontrivial(F.lit(" n/a ")), False),
    (lambda: fn.nontrivial(F.lit("0.0")), True),
    (lambda: fn.without_prefix(F.lit("a:b:c")), "b:c"),
    (lambda: fn.type_name(F.lit("ns:USAmountType")), "ns:USAmountType"),
    (lambda: fn.type_name(F.lit("USAmountType")), "Dollar amount (USD)"),
    (lambda: fn.parent_of(F.lit("/A")), ""),
    (lambda: fn.parent_of(F.lit("/A/B/C")), "/A/B"),
    (lambda: fn.frequency_band(F.lit(10.0)), "orange"),
    (lambda: fn.frequency_band(F.lit(None).cast("double")), "N/A"),
    (lambda: fn.form_title(F.lit("IRS990EZ")), "Form 990-EZ (Short)"),
    (lambda: fn.rename_status(F.lit("/a"), F.lit(0.8)), "PROBABLE_RENAME"),
    (lambda: fn.rename_status(F.lit(None).cast("string"), F.lit(None).cast("double")), "NEEDS_REVIEW"),
    (lambda: fn.older_name(F.lit("CityNm")), "City"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_goldens(spark, k):
    column, want = CASES[k]
    got = one(spark, column())
    assert (tuple(got) if isinstance(want, tuple) else got) == want


def test_resolution(spark):
    have = ["2016v3.0", "2018v3.1", "2018v3.2", "2020v4.2"]
    xpaths = spark.createDataFrame([("f", v, f"/{v}") for v in have], "canonical_name string, version string, xpath string")
    asked = {"2018v3.1": "2018v3.1", "2018v9.0": "2018v3.2", "2019v5.0": "2018v3.2", "2013v3.0": "2020v4.2", "": "2020v4.2", "2024v1.0": "2020v4.2"}
    got = {r["version"]: r["xpath"] for r in resolve_paths(xpaths, spark.createDataFrame([(v,) for v in asked], "version string")).collect()}
    assert got == {v: f"/{x}" for v, x in asked.items()}
