"""Beneficiary files to enrolment, demographic and death tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.scalars import HISPANIC, RACE, SEX, end_of_month, joined_key, last_months_start, recode
from claimloom.operators.intervals import coverage_timeline, episode_spans
from claimloom.operators.joins import match_lookup
from claimloom.operators.rows import pivot_sum
from claimloom.schema import STUDY_END

YEARS = (2008, 2009, 2010)
KINDS = {"Med": "medcov", "Drug": "drugcov"}
PERSON = ("samplenum", "PatID")


def coverage_summary(bene: DataFrame) -> DataFrame:
    """Months of each coverage per person and year.

    ``bene`` is the tagged union of the yearly files (columns samplenum, YEAR
    and the beneficiary columns).
    """
    months = bene.select(
        "samplenum",
        F.col("DESYNPUF_ID").alias("PatID"),
        "YEAR",
        "BENE_DEATH_DT",
        F.col("BENE_HI_CVRAGE_TOT_MONS").alias("hi"),
        F.col("BENE_SMI_CVRAGE_TOT_MONS").alias("smi"),
        F.col("BENE_HMO_CVRAGE_TOT_MONS").alias("hmo"),
        F.trim("PLAN_CVRG_MOS_NUM").try_cast("double").cast("int").alias("plan"),
    )
    measures = {"hi": "a", "smi": "b", "hmo": "hmo", "plan": "drugcov"}
    sums = pivot_sum(months, PERSON, "YEAR", YEARS, measures, extra=[F.min("BENE_DEATH_DT").alias("death_dt")])
    ab = {f"ab_{y}": F.least(f"a_{y}", f"b_{y}") for y in YEARS}
    med = {f"medcov_{y}": F.least(f"ab_{y}", 12 - F.col(f"hmo_{y}")) for y in YEARS}
    return sums.withColumns(ab).withColumns(med)


def _intervals_of(prefix: str) -> Column:
    m08, m09, m10 = (F.col(f"{prefix}_{y}") for y in YEARS)
    death = F.col("death_dt")

    def day(text: str) -> Column:
        return F.lit(text).cast("date")

    def span(when: Column, start: Column, end: Column) -> Column:
        return F.when(when, F.struct(start.alias("Enr_Start"), end.alias("Enr_End")))

    def known(m: Column) -> Column:  # missing compares below every number
        return F.coalesce(m, F.lit(-1))

    falls = known(m08) >= known(m10)
    later = F.coalesce(m09, F.lit(0)) + F.coalesce(m10, F.lit(0))
    ends_2008 = F.coalesce(F.year(death) == 2008, F.lit(False)) | (
        (later == 0) & (m09.isNotNull() | m10.isNotNull())
    )
    full_2009 = known(m09) >= 12
    return F.array(
        span(falls & ends_2008, day("2008-01-01"), F.least(death, end_of_month(2008, m08))),
        span(falls & ~ends_2008, last_months_start(2008, m08), day("2008-12-31")),
        span(falls & ~ends_2008, day("2009-01-01"), F.least(death, end_of_month(2009, m09))),
        span(~falls, last_months_start(2009, m09), day("2009-12-31")),
        span(~falls & ~full_2009, day("2008-01-01"), end_of_month(2008, m08)),
        span(~falls & full_2009, last_months_start(2008, m08), day("2008-12-31")),
        span(m10 > 0, day("2010-01-01"), F.least(death, end_of_month(2010, m10))),
    )


def coverage_intervals(summary: DataFrame, kinds: dict[str, str] = KINDS) -> DataFrame:
    """Dated coverage intervals of each kind from the months per year; one-day intervals are left out."""
    per_kind = F.array(*[F.struct(F.lit(k).alias("kind"), _intervals_of(p).alias("found")) for k, p in kinds.items()])
    listed = summary.select(*PERSON, F.inline(per_kind))
    return listed.select(*PERSON, "kind", F.inline("found")).where(F.col("Enr_Start") < F.col("Enr_End"))


def build_enrollment(bene: DataFrame, study_end: str = STUDY_END) -> DataFrame:
    """Enrolment periods with medical and drug coverage flags.

    Everything is grouped by person, so the beneficiary rows are shuffled once.
    """
    intervals = coverage_intervals(coverage_summary(bene))
    spans = episode_spans(intervals, [*PERSON, "kind"], "Enr_Start", "Enr_End", grace=0)
    periods = coverage_timeline(
        spans, PERSON, "kind", {"Med": "MedCov", "Drug": "DrugCov"}, "Enr_Start_span", "Enr_End_span", study_end
    )
    return periods.select(
        *PERSON,
        F.col("PeriodStart").alias("Enr_Start"),
        F.col("PeriodEnd").alias("Enr_End"),
        "MedCov",
        "DrugCov",
        F.lit("N").alias("Chart"),
    )


def build_demographic(bene: DataFrame, zips: DataFrame, **options) -> DataFrame:
    """Distinct recoded person rows with the ZIP of their state and county."""
    people = bene.select(
        "samplenum",
        F.col("DESYNPUF_ID").alias("PatID"),
        F.col("BENE_BIRTH_DT").alias("Birth_Date"),
        recode("BENE_SEX_IDENT_CD", SEX, "U").alias("Sex"),
        recode("BENE_RACE_CD", HISPANIC, "U").alias("Hispanic"),
        recode("BENE_RACE_CD", RACE, "0").alias("Race"),
        joined_key("SP_STATE_CODE", "BENE_COUNTY_CD").alias("_area"),
    ).distinct()
    lookup = zips.select("ssacd", "ZIP").distinct()
    return match_lookup(people, lookup, F.col("_area"), "ssacd", **options).drop("_area").distinct()


def build_death(bene: DataFrame) -> DataFrame:
    """Distinct death dates with the fixed source marks."""
    return (
        bene.where(F.col("BENE_DEATH_DT").isNotNull())
        .select(
            "samplenum",
            F.col("DESYNPUF_ID").alias("PatID"),
            F.col("BENE_DEATH_DT").alias("DeathDt"),
            F.lit("D").alias("DtImpute"),
            F.lit("L").alias("Source"),
            F.lit("E").alias("Confidence"),
        )
        .distinct()
    )
