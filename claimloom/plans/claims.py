"""Claims feeds to typed code lines and classified encounter headers.

All feeds of all subsamples go through the same steps together; samplenum and
feed are grouping keys, so codes are decided separately for each pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.scalars import blank_to_null, first_present
from claimloom.operators.codes import (
    CODE_GROUPS,
    DX,
    PX,
    claim_flags,
    decide_codes,
    distinct_codes,
    listed_flags,
    match_codes,
    type_codes,
    typed_lines,
    unpivot_codes,
)
from claimloom.operators.intervals import count_inside
from claimloom.operators.joins import LARGE, measured_bytes, skew_join
from claimloom.operators.rows import first_segment, union_feeds, with_constants
from claimloom.workspace import Workspace

WITHIN = ("samplenum", "feed")
CLAIM = ("samplenum", "feed", "PatID", "EncounterID")
LISTS = ("ind_ed", "ind_home", "ind_is")

# Columns that name the provider, in order of preference.
PROVIDER = {
    "OP": ("AT_PHYSN_NPI", "OP_PHYSN_NPI", "OT_PHYSN_NPI", "PRVDR_NUM"),
    "CAR": ("PRF_PHYSN_NPI_1", "TAX_NUM_1"),
    "IP": ("AT_PHYSN_NPI", "OP_PHYSN_NPI", "OT_PHYSN_NPI", "PRVDR_NUM"),
}
NO_PROVIDER = "UNKNOWN"


def long_codes(feed: str, claims: DataFrame) -> DataFrame:
    """Code lines of one feed."""
    keys = claims.select(
        "samplenum",
        F.lit(feed).alias("feed"),
        F.col("DESYNPUF_ID").alias("PatID"),
        F.col("CLM_ID").alias("EncounterID"),
        *[c for c in claims.columns if c.lower().startswith(("icd9_", "line_icd9_", "hcpcs_"))],
    )
    return unpivot_codes(keys, CLAIM, CODE_GROUPS[feed])


def resolve_codes(long: DataFrame, master: DataFrame, **options) -> DataFrame:
    """Decision table: one row per code, source kind and listed kind.

    Only distinct codes leave the tasks that read the lines.
    """
    kinds = long.select(*WITHIN, "sourcecode", "sourcecat", "sourcetype").distinct()
    return decide_codes(match_codes(kinds, master, WITHIN, **options), WITHIN)


def dx_columns(lines: DataFrame, *extra: str) -> DataFrame:
    """Diagnosis columns of typed lines; the primary flag is kept for inpatient claims only."""
    return lines.select(
        *CLAIM,
        *extra,
        F.col("code").alias("DX"),
        F.col("codetype").alias("Dx_Codetype"),
        F.col("code").alias("OrigDX"),
        F.when(F.col("feed") == "IP", F.when(F.col("first_dx"), "P").otherwise("S")).alias("PDX"),
        F.lit("U").alias("PAdmit"),
    )


def px_columns(lines: DataFrame, *extra: str) -> DataFrame:
    """Procedure columns of typed lines."""
    return lines.select(
        *CLAIM, *extra, F.col("code").alias("PX"), F.col("codetype").alias("PX_CodeType"), F.col("code").alias("OrigPX")
    )


def dx_lines(long: DataFrame, decided: DataFrame, **options) -> DataFrame:
    """Distinct diagnosis lines per claim."""
    return dx_columns(distinct_codes(type_codes(long, decided, DX, WITHIN, **options)))


def px_lines(long: DataFrame, decided: DataFrame, **options) -> DataFrame:
    """Distinct procedure lines per claim."""
    return px_columns(distinct_codes(type_codes(long, decided, PX, WITHIN, **options)))


_NO_STAY = ("Facility_Code", "Discharge_Disposition", "Discharge_Status", "DRG", "DRG_Type", "Admitting_Source")
_STAY = {"Discharge_Disposition": "U", "Discharge_Status": "UN", "DRG_Type": "2", "Admitting_Source": "UN"}
_HEADER = ("ADate", "DDate", "Provider", "EncType", *_NO_STAY)


def _claim_keys(feed: str, claims: DataFrame, **columns: Column) -> DataFrame:
    """Claim keys and named columns; nothing else of the wide claims is read."""
    return claims.select(
        "samplenum",
        F.lit(feed).alias("feed"),
        F.col("DESYNPUF_ID").alias("PatID"),
        F.col("CLM_ID").alias("EncounterID"),
        first_present(PROVIDER[feed], NO_PROVIDER).alias("Provider"),
        *[c.alias(name) for name, c in columns.items()],
    )


def type_lines(long: DataFrame, decided: DataFrame, lists: dict[str, DataFrame], **options) -> DataFrame:
    """All code lines with destination, type and code-list flags, in one join of lines and decisions."""
    named = dict(zip(LISTS, (lists["ed"], lists["home"], lists["is"])))
    return typed_lines(long, listed_flags(decided, named), WITHIN, LISTS, **options)


def flag_claims(lines: DataFrame) -> DataFrame:
    """Per claim, whether a procedure is on the emergency, home or institutional list."""
    return claim_flags(lines.where(F.col("route") == PX), LISTS, CLAIM)


def _classified(headers: DataFrame, flags: DataFrame, kind: Column, options: dict) -> DataFrame:
    # One row of flags per claim: not measured, planned as a shuffle join that
    # Spark may still turn into a broadcast.  Headers are made distinct after
    # the join, where they already lie together by claim.
    options = {"right_bytes": LARGE, **options}
    # The claim id comes first, as in ``attach_header``.
    on = ["EncounterID", "PatID", "samplenum", "feed"]
    joined = skew_join(headers.withColumn("DDate", F.lit(None).cast("date")), flags, on, "left", **options)
    return with_constants(joined.withColumn("EncType", kind), dict.fromkeys(_NO_STAY)).select(*CLAIM, *_HEADER).distinct()


def classify_op(claims: DataFrame, flags: DataFrame, **options) -> DataFrame:
    """Outpatient headers: ED, else OA for a home or institutional code, else AV."""
    kind = F.when(F.col("ind_ed"), "ED").when(F.col("ind_home") | F.col("ind_is"), "OA").otherwise("AV")
    headers = _claim_keys("OP", first_segment(claims), ADate=F.col("CLM_FROM_DT"))
    return _classified(headers, flags.where(F.col("feed") == "OP"), kind, options)


def classify_car(claims: DataFrame, flags: DataFrame, **options) -> DataFrame:
    """Carrier headers: OA for a home or institutional code, else AV; emergency codes play no part."""
    kind = F.when(F.col("ind_home") | F.col("ind_is"), "OA").otherwise("AV")
    headers = _claim_keys("CAR", claims, ADate=F.col("CLM_FROM_DT"))
    return _classified(headers, flags.where(F.col("feed") == "CAR"), kind, options)


def classify_ip(claims: DataFrame, visits: DataFrame, ws: Workspace, **options) -> DataFrame:
    """Inpatient headers: IS for a stay over two days with an OA visit inside it, else IP.

    ``visits`` are classified OP and CAR headers.
    """
    stays = _claim_keys(
        "IP",
        first_segment(claims),
        ADate=F.col("CLM_ADMSN_DT"),
        DDate=F.col("NCH_BENE_DSCHRG_DT"),
        Facility_Code=blank_to_null("PRVDR_NUM"),
        DRG=blank_to_null("CLM_DRG_CD"),
    ).distinct()
    oa = visits.where(F.col("EncType") == "OA").select("samplenum", "PatID", F.col("ADate").alias("visit"))
    seen = count_inside(stays, oa, ("samplenum", "PatID"), "ADate", "DDate", "visit", "n_oa", ws, **options)
    kind = F.when((F.col("n_oa") > 0) & (F.datediff("DDate", "ADate") > 2), "IS").otherwise("IP")
    return with_constants(seen.withColumn("EncType", kind), _STAY).select(*CLAIM, *_HEADER)


def attach_header(lines: DataFrame, headers: DataFrame, columns: tuple[str, ...], **options) -> DataFrame:
    """Add header columns to code lines, matching on the claim id alone (within feed and subsample)."""
    # A sort compares the first key first, so the one of most values comes first.
    on = ["EncounterID", "samplenum", "feed"]
    chosen = headers.select(*on, *columns)
    joined = skew_join(lines, chosen.distinct(), on, "inner", **{"right_bytes": measured_bytes(chosen), **options})
    keys = ["samplenum", "feed", "EncounterID"]
    return joined.select(*keys, *[c for c in joined.columns if c not in keys])


@dataclass
class Claims:
    """Classified headers and typed code lines of all feeds."""

    headers: DataFrame
    lines: DataFrame

    def typed(self, route: str) -> DataFrame:
        return self.lines.where(F.col("route") == route).drop("route", *LISTS)


def process_claims(
    feeds: dict[str, DataFrame], master: DataFrame, lists: dict[str, DataFrame], ws: Workspace, **options
) -> Claims:
    """Run code resolution and encounter classification over the OP, CAR and IP feeds."""
    # No later step asks for a code's column name.
    long = ws.keep(union_feeds(*[long_codes(name, frame).drop("sourcevar") for name, frame in feeds.items()]), "code-lines")
    decided = ws.keep(resolve_codes(long, master, **options), "decided")
    lines = ws.keep(type_lines(long, decided, lists, **options), "typed-lines")
    # A claim without a row of flags is classified as one whose flags are all false.
    listed = lines.where(F.greatest(*LISTS))
    flags = ws.keep(flag_claims(listed), "claim-flags")
    visits = union_feeds(classify_op(feeds["OP"], flags, **options), classify_car(feeds["CAR"], flags, **options))
    visits = ws.keep(visits, "visits")
    headers = ws.keep(union_feeds(visits, classify_ip(feeds["IP"], visits, ws, **options)), "headers")
    return Claims(headers, lines)
