import datetime as dt

import pytest

from claimloom.plans import enrollment

COLS = (
    "DESYNPUF_ID string, YEAR int, BENE_DEATH_DT date, BENE_HI_CVRAGE_TOT_MONS int, BENE_SMI_CVRAGE_TOT_MONS int,"
    " BENE_HMO_CVRAGE_TOT_MONS int, PLAN_CVRG_MOS_NUM string, samplenum int"
)


def bene(spark, med, drug=("0", "0", "0"), hmo=(0, 0, 0), death=None, smi=None):
    smi = smi or (12, 12, 12)
    rows = [("p", y, death, med[i], smi[i], hmo[i], drug[i], 1) for i, y in enumerate((2008, 2009, 2010))]
    return spark.createDataFrame(rows, COLS)


def med_intervals(spark, months, death=None):
    out = enrollment.coverage_intervals(enrollment.coverage_summary(bene(spark, months, death=death)))
    return sorted((str(r["Enr_Start"]), str(r["Enr_End"])) for r in out.where("kind = 'Med'").collect())


@pytest.mark.parametrize(
    "months, death, want",
    [
        # fewer or equal months in 2010 than in 2008
        ((6, 0, 0), None, [("2008-01-01", "2008-06-30")]),
        ((12, 3, 0), None, [("2008-01-01", "2008-12-31"), ("2009-01-01", "2009-03-31")]),
        ((3, 12, 2), None, [("2008-10-01", "2008-12-31"), ("2009-01-01", "2009-12-31"), ("2010-01-01", "2010-02-28")]),
        ((12, 0, 0), dt.date(2008, 5, 10), [("2008-01-01", "2008-05-10")]),
        ((12, 6, 0), dt.date(2009, 2, 10), [("2008-01-01", "2008-12-31"), ("2009-01-01", "2009-02-10")]),
        # more months in 2010 than in 2008; no cap at death before 2010
        ((2, 5, 12), None, [("2008-01-01", "2008-02-29"), ("2009-08-01", "2009-12-31"), ("2010-01-01", "2010-12-31")]),
        ((2, 12, 12), None, [("2008-11-01", "2008-12-31"), ("2009-01-01", "2009-12-31"), ("2010-01-01", "2010-12-31")]),
        ((0, 4, 6), dt.date(2010, 3, 15), [("2009-09-01", "2009-12-31"), ("2010-01-01", "2010-03-15")]),
        ((0, 0, 0), None, []),
        # a one-day interval is not emitted
        ((12, 12, 12), dt.date(2010, 1, 1), [("2008-01-01", "2008-12-31"), ("2009-01-01", "2009-12-31")]),
    ],
)
def test_coverage_rules(spark, months, death, want):
    assert med_intervals(spark, months, death) == want


def test_summary_takes_the_least_and_subtracts_hmo(spark):
    out = enrollment.coverage_summary(bene(spark, (12, 10, 8), hmo=(5, 0, 12), drug=("07", "xx", " 3"), smi=(12, 4, 9))).first()
    assert [out[f"ab_{y}"] for y in enrollment.YEARS] == [12, 4, 8]
    assert [out[f"medcov_{y}"] for y in enrollment.YEARS] == [7, 4, 0]
    assert [out[f"drugcov_{y}"] for y in enrollment.YEARS] == [7, 0, 3]


def test_enrollment_joins_adjacent_years(spark):
    out = enrollment.build_enrollment(bene(spark, (12, 12, 12), drug=("0", "6", "12")))
    got = sorted((str(r["Enr_Start"]), str(r["Enr_End"]), r["MedCov"], r["DrugCov"], r["Chart"]) for r in out.collect())
    assert got == [("2008-01-01", "2009-06-30", "Y", "N", "N"), ("2009-07-01", "2010-12-31", "Y", "Y", "N")]


def test_enrollment_shuffles_once(spark):
    plan = enrollment.build_enrollment(bene(spark, (12, 12, 12)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_demographic_and_death(spark):
    rows = [("p", dt.date(1930, 1, 1), "1", "5", "1 ", "2", None, 1)] * 3 + [
        ("q", dt.date(1940, 1, 1), "9", "1", "7", "7", dt.date(2009, 1, 1), 1)
    ]
    df = spark.createDataFrame(
        rows,
        "DESYNPUF_ID string, BENE_BIRTH_DT date, BENE_SEX_IDENT_CD string, BENE_RACE_CD string, SP_STATE_CODE string,"
        " BENE_COUNTY_CD string, BENE_DEATH_DT date, samplenum int",
    )
    zips = spark.createDataFrame([("12", "00012")], "ssacd string, ZIP string")
    got = sorted(tuple(r)[1:] for r in enrollment.build_demographic(df, zips).collect())
    assert [g[2:] for g in got] == [("M", "Y", "0", "00012"), ("U", "N", "5", None)]
    assert [tuple(r)[1:] for r in enrollment.build_death(df).collect()] == [("q", dt.date(2009, 1, 1), "D", "L", "E")]
