"""Declared table and crosswalk contracts.

Ids may arrive as strings or integers, so a table is declared with the id
type its source uses; after re-keying every id is a long.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STUDY_START = "2008-01-01"
STUDY_END = "2010-12-31"

_DDL = {"id": T.LongType(), "date": T.DateType(), "str": T.StringType(), "int": T.IntegerType(), "long": T.LongType()}


@dataclass(frozen=True)
class TableSpec:
    """Column contract of one common-model table.

    ``fields`` maps column name to a kind (``id``, ``date``, ``str``, ``int``, ``long``)
    in output order; ``rekeyed`` maps an id column to its join type;
    ``tie_breaks`` extend ``sort_keys`` so that the written order is total.
    """

    name: str
    fields: dict[str, str]
    sort_keys: tuple[str, ...]
    rekeyed: dict[str, str]
    tie_breaks: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.fields)

    @property
    def order(self) -> tuple[str, ...]:
        """Sort keys, then declared tie-breaks, then all remaining columns."""
        head = self.sort_keys + self.tie_breaks
        return head + tuple(c for c in self.columns if c not in head)

    def struct(self, id_type: T.DataType | None = None, samplenum: bool = True) -> T.StructType:
        """Full schema of a tagged source of this table."""
        out = T.StructType()
        for name, kind in self.fields.items():
            out.add(name, id_type if kind == "id" and id_type is not None else _DDL[kind])
        return out.add("samplenum", T.IntegerType()) if samplenum else out


@dataclass(frozen=True)
class CrosswalkSpec:
    """Where the original values of one id come from."""

    id_column: str
    source_table: str
    name: str

    @property
    def orig(self) -> str:
        return f"orig_{self.id_column}"


_DETAIL_IDS = {"PatID": "inner", "EncounterID": "left", "ProviderID": "left"}

# Table names, column names and order, sort keys and join types.
_TABLES = (
    TableSpec(
        "enrollment",
        {
            "PatID": "id",
            "Enr_Start": "date",
            "Enr_End": "date",
            "MedCov": "str",
            "DrugCov": "str",
            "Chart": "str",
            "PlanType": "str",
            "PayerType": "str",
        },
        ("PatID", "Enr_Start", "Enr_End", "MedCov", "DrugCov", "Chart"),
        {"PatID": "inner"},
    ),
    TableSpec(
        "demographic",
        {
            "PatID": "id",
            "Birth_Date": "date",
            "Sex": "str",
            "Hispanic": "str",
            "Race": "str",
            "PostalCode": "str",
            "PostalCode_Date": "date",
            "ImputedRace": "str",
            "ImputedHispanic": "str",
        },
        ("PatID",),
        {"PatID": "inner"},
    ),
    TableSpec(
        "dispensing",
        {
            "PatID": "id",
            "ProviderID": "id",
            "RxDate": "date",
            "Rx": "str",
            "Rx_CodeType": "str",
            "RxSup": "long",
            "RxAmt": "long",
        },
        ("PatID", "RxDate"),
        {"PatID": "inner"},
        ("Rx_CodeType", "Rx", "ProviderID"),
    ),
    TableSpec(
        "encounter",
        {
            "PatID": "id",
            "EncounterID": "id",
            "ADate": "date",
            "DDate": "date",
            "EncType": "str",
            "FacilityID": "id",
            "Discharge_Disposition": "str",
            "Discharge_Status": "str",
            "DRG": "str",
            "DRG_Type": "str",
            "Admitting_Source": "str",
        },
        ("PatID", "ADate"),
        {"PatID": "inner", "EncounterID": "left", "FacilityID": "left"},
    ),
    TableSpec(
        "diagnosis",
        {
            "PatID": "id",
            "EncounterID": "id",
            "ADate": "date",
            "ProviderID": "id",
            "EncType": "str",
            "DX": "str",
            "Dx_Codetype": "str",
            "OrigDX": "str",
            "PDX": "str",
            "PAdmit": "str",
        },
        ("PatID", "ADate"),
        _DETAIL_IDS,
    ),
    TableSpec(
        "procedure",
        {
            "PatID": "id",
            "EncounterID": "id",
            "ADate": "date",
            "ProviderID": "id",
            "EncType": "str",
            "PX": "str",
            "PX_CodeType": "str",
            "OrigPX": "str",
        },
        ("PatID", "ADate"),
        _DETAIL_IDS,
    ),
    TableSpec(
        "death",
        {"PatID": "id", "DeathDt": "date", "DtImpute": "str", "Source": "str", "Confidence": "str"},
        ("PatID",),
        {"PatID": "inner"},
    ),
    TableSpec("provider", {"ProviderID": "id", "Specialty": "str", "Specialty_CodeType": "str"}, ("ProviderID",), {}),
    TableSpec("facility", {"FacilityID": "id", "Facility_Location": "str"}, ("FacilityID",), {}),
)
TABLES: dict[str, TableSpec] = {t.name: t for t in _TABLES}

# The four id crosswalks and their source tables.
CROSSWALKS: dict[str, CrosswalkSpec] = {
    c.id_column: c
    for c in (
        CrosswalkSpec("PatID", "demographic", "patid_crosswalk"),
        CrosswalkSpec("EncounterID", "encounter", "encounterid_crosswalk"),
        CrosswalkSpec("ProviderID", "provider", "providerid_crosswalk"),
        CrosswalkSpec("FacilityID", "facility", "facilityid_crosswalk"),
    )
}

# Tables that come from the sources; the other two are made from crosswalks.
SOURCED_TABLES = tuple(n for n in TABLES if n not in ("provider", "facility"))


def _raw(names: str, kind: str) -> list[str]:
    return [f"{n} {kind}" for n in names.split()]


def _numbered(name: str, count: int) -> list[str]:
    return [f"{name}_{n} string" for n in range(1, count + 1)]


_FACILITY_CODES = _numbered("ICD9_DGNS_CD", 10) + _numbered("ICD9_PRCDR_CD", 6) + _numbered("HCPCS_CD", 45)

# The columns of the raw feeds that are read, and their kinds.
RAW_FEEDS: dict[str, str] = {
    "bene": ", ".join(
        _raw("DESYNPUF_ID", "string")
        + _raw("BENE_BIRTH_DT BENE_DEATH_DT", "date")
        + _raw("BENE_SEX_IDENT_CD BENE_RACE_CD SP_STATE_CODE BENE_COUNTY_CD", "string")
        + _raw("BENE_HI_CVRAGE_TOT_MONS BENE_SMI_CVRAGE_TOT_MONS BENE_HMO_CVRAGE_TOT_MONS", "int")
        + _raw("PLAN_CVRG_MOS_NUM", "string")
    ),
    "pde": "DESYNPUF_ID string, SRVC_DT date, PROD_SRVC_ID string, DAYS_SUPLY_NUM int, QTY_DSPNSD_NUM int",
    "op": ", ".join(
        _raw("DESYNPUF_ID CLM_ID", "string")
        + ["SEGMENT int", "CLM_FROM_DT date"]
        + _raw("AT_PHYSN_NPI OP_PHYSN_NPI OT_PHYSN_NPI PRVDR_NUM", "string")
        + _FACILITY_CODES
    ),
    "ip": ", ".join(
        _raw("DESYNPUF_ID CLM_ID", "string")
        + ["SEGMENT int", "CLM_ADMSN_DT date", "NCH_BENE_DSCHRG_DT date"]
        + _raw("AT_PHYSN_NPI OP_PHYSN_NPI OT_PHYSN_NPI PRVDR_NUM CLM_DRG_CD", "string")
        + _FACILITY_CODES
    ),
    "car": ", ".join(
        _raw("DESYNPUF_ID CLM_ID", "string")
        + ["CLM_FROM_DT date"]
        + _raw("PRF_PHYSN_NPI_1 TAX_NUM_1", "string")
        + _numbered("ICD9_DGNS_CD", 10)
        + _numbered("LINE_ICD9_DGNS_CD", 13)
        + _numbered("HCPCS_CD", 45)
    ),
}

# The lookup files of the translation.
LOOKUP_FILES: dict[str, str] = {
    **dict.fromkeys(("master", "ed", "home", "institutional"), "ClinCode string, ClinCodeCat string, ClinCodeType string"),
    "zips": "ssacd string, ZIP string",
}
