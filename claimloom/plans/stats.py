"""Descriptive statistics per subsample: 40 columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.scalars import months_touched, whole_years
from claimloom.operators.rows import union_feeds
from claimloom.schema import STUDY_START

# Categories that get a column of their own.
SEXES = ("A", "F", "M", "U")
RACES = ("0", "1", "2", "3", "4", "5")
ENC_TYPES = ("AV", "ED", "IP", "IS", "OA")


def events_per_patient(patients: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """Events of each patient, zero included: one grouped sum over both inputs."""
    both = patients.select("samplenum", "PatID", F.lit(0).alias("_n"), F.lit(True).alias("_patient")).unionByName(
        events.select("samplenum", "PatID", F.lit(1).alias("_n"), F.lit(False).alias("_patient"))
    )
    sums = both.groupBy("samplenum", "PatID").agg(F.sum("_n").alias(name), F.max("_patient").alias("_patient"))
    return sums.where("_patient").drop("_patient")


def _spread(patients: DataFrame, events: DataFrame, unit: str) -> DataFrame:
    # Patients with the same count are counted first, so the exact median
    # works on one row per distinct count.
    per = events_per_patient(patients, events, "n").groupBy("samplenum", "n").agg(F.count(F.lit(1)).alias("w"))
    mean = F.sum(F.col("n") * F.col("w")) / F.sum("w")
    return per.groupBy("samplenum").agg(
        F.round(mean).cast("long").alias(f"Mean_{unit}_PatID"),
        F.round(F.percentile("n", F.lit(0.5), F.col("w"))).cast("long").alias(f"Median_{unit}_PatID"),
        F.min("n").cast("long").alias(f"Min_{unit}_PatID"),
        F.max("n").cast("long").alias(f"Max_{unit}_PatID"),
    )


def _count_if(cond, name):
    return F.count_if(cond).alias(name)


def descriptive_stats(tables: dict[str, DataFrame], age_on: str = STUDY_START) -> DataFrame:
    """Counts, spreads and enrolled months per subsample of the tagged tables.

    Our choices where no definition is known: age is taken on ``age_on``, an
    enrolment period counts each calendar month it touches, and means and
    medians are rounded to whole numbers.
    """
    demo, enc, disp, enr = (tables[t] for t in ("demographic", "encounter", "dispensing", "enrollment"))
    age = whole_years("Birth_Date", age_on)
    patients = demo.groupBy("samplenum").agg(
        F.count(F.lit(1)).alias("PatIDs"),
        _count_if(age < 18, "Pats_Under18"),
        _count_if(age.between(18, 64), "Pats_18to64"),
        _count_if(age >= 65, "Pats_65plus"),
        *[_count_if(F.col("Sex") == s, f"Pats_Sex{s}") for s in SEXES],
        *[_count_if(F.col("Race") == r, f"Pats_Race{r}") for r in RACES],
        F.count(F.lit(1)).alias("N_Obs_Demographic"),
    )
    encounters = enc.groupBy("samplenum").agg(
        F.count(F.lit(1)).alias("EncounterIDs"),
        *[_count_if(F.col("EncType") == t, f"EncounterIDs_{t}") for t in ENC_TYPES],
        F.count(F.lit(1)).alias("N_Obs_Encounter"),
    )
    months = months_touched("Enr_Start", "Enr_End").cast("long")
    med, drug = F.col("MedCov") == "Y", F.col("DrugCov") == "Y"

    def months_where(cond, name):
        return F.coalesce(F.sum(F.when(cond, months)), F.lit(0)).alias(name)

    enrolled = enr.groupBy("samplenum").agg(
        months_where(med & drug, "EnrollMonths_MedDrug"),
        months_where(med & ~drug, "EnrollMonths_MedOnly"),
        months_where(~med & drug, "EnrollMonths_DrugOnly"),
        F.count(F.lit(1)).alias("N_Obs_Enrollment"),
    )
    dispensings = disp.groupBy("samplenum").agg(
        F.count(F.lit(1)).alias("Dispensings"), F.count(F.lit(1)).alias("N_Obs_Dispensing")
    )
    others = [
        tables[t].groupBy("samplenum").agg(F.count(F.lit(1)).alias(f"N_Obs_{t.capitalize()}"))
        for t in ("diagnosis", "procedure", "death")
    ]
    # Each part has a few columns of one row per subsample; put side by side by a grouped maximum.
    spreads = (_spread(demo, enc, "Encounters"), _spread(demo, disp, "Dispensings"))
    parts = union_feeds(patients, encounters, dispensings, enrolled, *spreads, *others)
    rows = parts.groupBy("samplenum").agg(*[F.max(c).cast("long").alias(c) for c in _ORDER]).where(F.col("PatIDs") > 0)
    filled = rows.fillna(0, [c for c in _ORDER if not c.startswith(("Mean_", "Median_", "Min_", "Max_"))])
    return filled.select(F.col("samplenum").alias("SubSample"), *_ORDER)


def _columns() -> Sequence[str]:
    def spread(unit):
        return [f"{f}_{unit}_PatID" for f in ("Mean", "Median", "Min", "Max")]

    tables = ("Demographic", "Enrollment", "Dispensing", "Encounter", "Diagnosis", "Procedure", "Death")
    return [
        "PatIDs", "Pats_Under18", "Pats_18to64", "Pats_65plus",
        *[f"Pats_Sex{s}" for s in SEXES],
        *[f"Pats_Race{r}" for r in RACES],
        "EncounterIDs", *[f"EncounterIDs_{t}" for t in ENC_TYPES], *spread("Encounters"),
        "Dispensings", *spread("Dispensings"),
        "EnrollMonths_MedDrug", "EnrollMonths_MedOnly", "EnrollMonths_DrugOnly",
        *[f"N_Obs_{t}" for t in tables],
    ]


_ORDER = _columns()
