"""Last step of the translation: study window, new ids per subsample, final tables.

Encounter and provider ids are given to the claim headers first; the much
longer code lines then pick them up in the one join that brings their header.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.codes import DX, PX, distinct_codes
from claimloom.operators.ids import build_crosswalk
from claimloom.operators.joins import skew_join
from claimloom.operators.rows import contract_columns, date_if_present, min_max_by, study_window, with_constants
from claimloom.plans.claims import Claims, attach_header, dx_columns, px_columns
from claimloom.plans.combine import FACILITY_FIELDS, PROVIDER_FIELDS
from claimloom.schema import TABLES
from claimloom.workspace import Workspace, run_together

PERSON = ("samplenum", "PatID")
_BROUGHT = ("new_id", "ADate", "ProviderID", "EncType")
CLAIM_TABLES = {"encounter", "diagnosis", "procedure", "provider", "facility"}


def first_enrollment(enrollment: DataFrame) -> DataFrame:
    """First enrolment date per person; only enrolled persons have a row."""
    return min_max_by(enrollment, PERSON, first_enr_dt=("min", "Enr_Start"))


def finalise(
    enrollment: DataFrame,
    demographic: DataFrame,
    death: DataFrame,
    dispensing: DataFrame,
    claims: Claims | None,
    ws: Workspace,
    only: Collection[str] = tuple(TABLES),
    dispensing_keys: DataFrame | None = None,
    **options,
) -> dict[str, DataFrame]:
    """The final tables (or those in ``only``) of every subsample, each with samplenum.

    Ids restart at 1 per subsample.  Only persons with an enrolment period are kept.
    ``dispensing_keys`` has the (samplenum, PatID) of the drug events, to look
    for hot persons without summing the events first.
    """
    out: dict[str, DataFrame] = {}

    def put(table: str, df: DataFrame, distinct: bool = True) -> None:
        shaped = df.select("samplenum", *contract_columns(df, TABLES[table]))
        out[table] = shaped.distinct() if distinct else shaped

    firsts = ws.keep(first_enrollment(enrollment), "first-enrollment")
    wanted = set(only)
    builds = {"PatID": partial(build_crosswalk, firsts, "PatID", ws, restart=True)}
    if CLAIM_TABLES & wanted:
        headers = study_window(claims.headers, "ADate")
        for id_column, orig in (("EncounterID", None), ("ProviderID", "Provider"), ("FacilityID", "Facility_Code")):
            builds[id_column] = partial(build_crosswalk, headers, id_column, ws, restart=True, orig=orig)
    built = dict(zip(builds, run_together(list(builds.values()))))
    people = built["PatID"]

    def person(df: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
        return people.apply(df, "inner", keys_from=keys_from, **options)

    # One row per person and period, and per person, date and drug: already distinct.
    if "enrollment" in only:
        put("enrollment", person(enrollment), distinct=False)
    if "dispensing" in only:
        fixed = {"ProviderID": F.lit(None).cast("long"), "Rx_CodeType": F.lit("ND")}
        named = dispensing.withColumnRenamed("NDC", "Rx").withColumns(fixed)
        put("dispensing", person(named, keys_from=dispensing_keys), distinct=False)
    if "demographic" in only:
        known = skew_join(demographic.withColumnRenamed("ZIP", "PostalCode"), firsts, PERSON, "inner", **options)
        dated = known.withColumn("PostalCode_Date", date_if_present("PostalCode", "first_enr_dt"))
        put("demographic", person(dated, keys_from=demographic))
    if "death" in only:
        put("death", person(death))
    if not CLAIM_TABLES & wanted:
        return out

    encounters, providers, facilities = (built[c] for c in ("EncounterID", "ProviderID", "FacilityID"))
    if "provider" in only:
        put("provider", with_constants(providers.frame, PROVIDER_FIELDS), distinct=False)
    if "facility" in only:
        put("facility", with_constants(facilities.frame, FACILITY_FIELDS), distinct=False)
    if not {"encounter", "diagnosis", "procedure"} & wanted:
        return out

    # Headers keep the original claim id, which the code lines still carry.
    named = headers.withColumnsRenamed({"Provider": "ProviderID", "Facility_Code": "FacilityID"})
    keyed = named.withColumn("claim", F.col("EncounterID"))
    for crosswalk in (encounters, providers, facilities):
        keyed = crosswalk.apply(keyed, "left", keys_from=named, **options)
    keyed = ws.keep(keyed, "keyed-headers")
    found = keyed.withColumnsRenamed({"EncounterID": "new_id", "claim": "EncounterID"})

    # Lines that share a claim's partition become distinct there, without
    # another shuffle.  Only a claim id used by two feeds needs more than that.
    claims_by_feed = headers.select("samplenum", "feed", "EncounterID").distinct().count()
    shared = claims_by_feed != encounters.rows

    def detail(table: str, route: str, columns) -> None:
        joined = attach_header(claims.typed(route), found, _BROUGHT, **options)
        if route == PX:
            joined = joined.withColumn("first_dx", F.lit(False))
        rows = columns(distinct_codes(joined), *_BROUGHT).drop("EncounterID").withColumnRenamed("new_id", "EncounterID")
        put(table, person(rows, keys_from=claims.lines), distinct=shared)

    if "encounter" in only:
        put("encounter", person(keyed))
    if "diagnosis" in only:
        detail("diagnosis", DX, dx_columns)
    if "procedure" in only:
        detail("procedure", PX, px_columns)
    return out
