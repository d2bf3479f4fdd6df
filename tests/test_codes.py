import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from claimloom.functions import scalars
from claimloom.operators import codes

W = ["samplenum", "feed"]


@pytest.mark.parametrize(
    "raw, want",
    [("G0101", "HC"), ("1234F", "C2"), ("1234T", "C3"), ("99213", "C4"), ("0331", "09"), ("O1234", "C4"), ("99  ", "09"), ("A1", "HC")],
)
def test_px_code_type(spark, raw, want):
    assert spark.range(1).select(scalars.px_code_type(F.lit(raw))).first()[0] == want


def test_unpivot_skips_blank_and_junk(spark):
    df = spark.createDataFrame(
        [(1, "OP", "c", "25O00", " ", "OTHER", None, "G0101 "), (1, "OP", "d", "XXXXX", "00000", "ABCDE", "TOTAL", None)],
        "samplenum int, feed string, CLM string, ICD9_DGNS_CD_1 string, ICD9_DGNS_CD_2 string, icd9_dgns_cd_3 string, ICD9_PRCDR_CD_6 string, HCPCS_CD_45 string",
    )
    got = rows_of(codes.unpivot_codes(df, ["samplenum", "feed", "CLM"], codes.CODE_GROUPS["OP"]))
    assert got == [
        (1, "OP", "c", "25000", "DX", "09", "icd9_dgns_cd", 1),
        (1, "OP", "c", "G0101", "PX", "HC", "hcpcs_cd", 45),
    ]
    with pytest.raises(ValueError):
        codes.unpivot_codes(df.select("samplenum"), ["samplenum"], codes.CODE_GROUPS["OP"])


MASTER = [
    ("A1", "PX", "HC"),  # one listed kind
    ("B1", "DX", "09"), ("B1", "DX", "10"), ("B1", "PX", "C4"),  # several
    ("C1", "DX", "10"), ("C1", "DX", "11"),
]
LINES = [  # code, source category, source type
    ("Z1", "DX", "09"),  # 1:0
    ("Z2", "DX", "09"), ("Z2", "PX", "C4"),  # MANY:0
    ("A1", "DX", "09"),  # 1:1, becomes PX
    ("B1", "DX", "09"), ("B1", "PX", "HC"),  # MANY:MANY
    ("C1", "PX", "C4"),  # 1:MANY, only leftovers
]


@pytest.fixture
def decided(spark):
    counted = spark.createDataFrame([(1, "IP", *r) for r in LINES], "samplenum int, feed string, sourcecode string, sourcecat string, sourcetype string")
    master = spark.createDataFrame(MASTER, "ClinCode string, ClinCodeCat string, ClinCodeType string")
    return codes.decide_codes(codes.match_codes(counted, master, W), W)


def test_decision_steps(decided):
    got = {(r["sourcecode"], r["sourcecat"], r["ClinCodeCat"], r["ClinCodeType"]): (r["step"], r["cat"], r["type"], r["route"]) for r in decided.collect()}
    assert got["Z1", "DX", None, None] == ("1", "DX", "OT", "DX")
    assert got["Z2", "PX", None, None] == ("2", "PX", "OT", "PX")
    assert got["A1", "DX", "PX", "HC"] == ("3", "PX", "HC", "PX")
    assert got["B1", "DX", "DX", "09"] == ("6.1", "DX", "09", "DX")
    assert got["B1", "DX", "DX", "10"] == ("6.2", "DX", "10", "DX")
    assert got["B1", "DX", "PX", "C4"][::3] == ("6.3", "LEFT")
    assert got["B1", "PX", "PX", "C4"] == ("6.2", "PX", "C4", "PX")
    assert got["C1", "PX", "DX", "10"] == ("5.3", "DX", "10", "DX")


def test_unmatched_are_leftovers_placed_nowhere(decided):
    assert {(r["sourcecode"], r["ClinCodeType"]) for r in codes.unmatched_codes(decided, W).collect()} == {("C1", "10"), ("C1", "11")}


def test_one_line_may_get_two_types_and_primary_wins(spark, decided):
    long = spark.createDataFrame(
        [(1, "IP", "x", "B1", "DX", "09", "icd9_dgns_cd", n) for n in (2, 1)],
        "samplenum int, feed string, claim string, sourcecode string, sourcecat string, sourcetype string, sourcevar string, sourcevarnum int",
    )
    got = rows_of(codes.distinct_codes(codes.type_codes(long, decided, "DX", W)).select("code", "codetype", "first_dx"))
    assert got == [("B1", "09", True), ("B1", "10", True)]


def test_claim_flags(spark):
    decided = spark.createDataFrame(
        [(1, "IP", "G1", "PX", "HC", "PX", "HC"), (1, "IP", "G2", "PX", "HC", "PX", "HC"), (1, "IP", "G1", "PX", "C4", "PX", "C4"), (1, "IP", "G2", "DX", "09", "DX", "HC")],
        "samplenum int, feed string, sourcecode string, sourcecat string, sourcetype string, route string, type string",
    )
    lists = {
        "ed": spark.createDataFrame([("G1", "HC")], "ClinCode string, ClinCodeType string"),
        "home": spark.createDataFrame([("G2", "HC"), ("G2", "HC")], "ClinCode string, ClinCodeType string"),
        "inst": spark.createDataFrame([("G9", "HC")], "ClinCode string, ClinCodeType string"),
    }
    long = spark.createDataFrame(
        [(1, "IP", c, code, cat, kind, "v", 1) for c, code, cat, kind in [("c", "G1", "PX", "HC"), ("c", "G2", "PX", "HC"), ("d", "G1", "PX", "C4"), ("e", "G2", "DX", "09")]],
        "samplenum int, feed string, claim string, sourcecode string, sourcecat string, sourcetype string, sourcevar string, sourcevarnum int",
    )
    lines = codes.typed_lines(long, codes.listed_flags(decided, lists), W, list(lists))
    got = codes.claim_flags(lines.where("route = 'PX'"), list(lists), ["claim"])
    assert rows_of(got) == [("c", True, True, False), ("d", False, False, False)]
    assert rows_of(lines.where("route = 'DX'").select("claim", "code", "first_dx", "home")) == [("e", "G2", True, False)]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.first_present([F.lit("  "), F.lit(None).cast("string"), F.lit("b")], "UNKNOWN"),
        scalars.first_present([F.lit(" ")], "UNKNOWN"),
        scalars.recode(F.lit(None).cast("string"), {"1": "M"}, "U"),
        scalars.joined_key(F.lit(" 1"), F.lit("2 ")),
        scalars.joined_key(F.lit(" "), F.lit(None).cast("string")),
        scalars.digits_only(F.lit("12-3")),
        scalars.digits_only(F.lit("12a")),
        scalars.whole_years(F.lit("1943-01-02").cast("date"), "2008-01-01"),
        scalars.months_touched(F.lit("2008-12-31").cast("date"), F.lit("2009-01-01").cast("date")),
    ).first()
    assert tuple(row) == ("b", "UNKNOWN", "U", "12", None, True, False, 64, 2)
