"""The driver's tables read as claims data.

Customers act as persons, orders as encounters and claims, line items as
claim lines and drug events, suppliers as providers, nations as facilities
and areas, parts as the master code list.  ``samplenum`` is 1 to 3.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.plans.claims import long_codes
from claimloom.plans.translate import Feeds, Lookups
from claimloom.workspace import Workspace

DX_CODE = """case when l_partkey % 97 = 0 then 'OTHER' when l_partkey % 89 = 0 then '00000'
    when l_partkey % 53 = 0 then 'ABCDE' else lpad(cast(l_partkey % 400 as string), 5, '0') end"""
PX_CODE = """case l_suppkey % 6
    when 0 then concat('G', lpad(cast(l_partkey % 300 as string), 4, '0'))
    when 1 then concat(lpad(cast(l_partkey % 300 as string), 4, '0'), 'F')
    when 2 then concat(lpad(cast(l_partkey % 300 as string), 4, '0'), 'T')
    when 3 then lpad(cast(l_partkey % 400 as string), 5, '0')
    when 4 then lpad(cast(l_partkey % 90 as string), 3, '0')
    else concat('O', lpad(cast(l_partkey % 300 as string), 4, '0')) end"""
ENC_TYPE = """case substr(o_orderpriority, 1, 1)
    when '1' then 'IP' when '2' then 'ED' when '3' then 'IS' when '4' then 'AV' else 'OA' end"""
CLAIM_DAY = "date_add(date'2007-12-15', cast(o_orderkey * 7 % 1140 as int))"


def as_number(code: Column) -> Column:
    """A code of up to five characters, without blanks, as a number of the same order."""
    return F.conv(F.hex(F.rpad(code, 5, " ")), 16, 10).cast("long")


def as_code(number: str) -> Column:
    return F.rtrim(F.unhex(F.hex(number)).cast("string"))


class Driver:
    """Domain frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, ws: Workspace):
        self.spark, self.dir, self.ws = spark, sf_dir, ws

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # Common-model sources

    def demographic(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "case when c_custkey % 41 <> 0 then c_custkey div 3 end as PatID",
            "date_add(date'1910-01-01', cast(c_custkey * 37 % 36500 as int)) as Birth_Date",
            "case c_nationkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'U' else 'A' end as Sex",
            "case c_nationkey % 3 when 0 then 'Y' when 1 then 'N' else 'U' end as Hispanic",
            "cast(c_nationkey % 6 as string) as Race",
            "case when c_nationkey % 5 <> 4 then lpad(cast(c_nationkey * 37 as string), 5, '0') end as PostalCode",
            "date_add(date'2008-01-01', cast(c_custkey % 365 as int)) as PostalCode_Date",
            "cast(c_custkey % 3 + 1 as int) as samplenum",
        )

    def enrollment(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "case when o_custkey % 41 <> 0 then o_custkey div 3 end as PatID",
            "to_date(o_orderdate) as Enr_Start",
            "date_add(to_date(o_orderdate), cast(30 + o_orderkey % 120 as int)) as Enr_End",
            "case when o_orderkey % 2 = 0 then 'Y' else 'N' end as MedCov",
            "case when o_orderkey % 3 = 0 then 'Y' else 'N' end as DrugCov",
            "'N' as Chart",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    def encounter(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "case when o_custkey % 41 <> 0 then o_custkey div 3 end as PatID",
            "case when o_orderkey % 37 <> 0 then o_orderkey end as EncounterID",
            "to_date(o_orderdate) as ADate",
            "date_add(to_date(o_orderdate), cast(o_orderkey % 200 as int)) as DDate",
            f"{ENC_TYPE} as EncType",
            "case when o_orderstatus <> 'P' then o_orderkey % 25 end as FacilityID",
            "cast(o_orderkey % 4 as string) as Discharge_Disposition",
            "cast(o_orderkey % 7 as string) as Discharge_Status",
            "lpad(cast(o_orderkey % 500 as string), 3, '0') as DRG",
            "'2' as DRG_Type",
            "cast(o_orderkey % 5 as string) as Admitting_Source",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    def provider(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey div 3 as ProviderID", "'00' as Specialty", "'1' as Specialty_CodeType",
            "cast(s_suppkey % 3 + 1 as int) as samplenum",
        )

    def facility(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "cast(n_nationkey as bigint) as FacilityID", "n_name as Facility_Location",
            "cast(n_nationkey % 3 + 1 as int) as samplenum",
        )

    def lines(self) -> DataFrame:
        return self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def diagnosis(self) -> DataFrame:
        return self.lines().selectExpr(
            "case when o_custkey % 41 <> 0 then o_custkey div 3 end as PatID",
            "case when o_orderkey % 37 <> 0 then o_orderkey end as EncounterID",
            "to_date(o_orderdate) as ADate",
            "l_suppkey div 3 as ProviderID",
            f"{ENC_TYPE} as EncType",
            f"{DX_CODE} as DX",
            "'09' as Dx_Codetype",
            f"{DX_CODE} as OrigDX",
            "case when l_linenumber = 1 then 'P' else 'S' end as PDX",
            "'U' as PAdmit",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    def procedure(self) -> DataFrame:
        return self.lines().selectExpr(
            "case when o_custkey % 41 <> 0 then o_custkey div 3 end as PatID",
            "case when o_orderkey % 37 <> 0 then o_orderkey end as EncounterID",
            "to_date(o_orderdate) as ADate",
            "l_suppkey div 3 as ProviderID",
            f"{ENC_TYPE} as EncType",
            f"{PX_CODE} as PX",
            "'C4' as PX_CodeType",
            f"{PX_CODE} as OrigPX",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    def dispensing(self) -> DataFrame:
        return self.lines().selectExpr(
            "case when o_custkey % 41 <> 0 then o_custkey div 3 end as PatID",
            "l_suppkey as ProviderID",
            "to_date(l_shipdate) as RxDate",
            "lpad(cast(l_partkey as string), 11, '0') as Rx",
            "'ND' as Rx_CodeType",
            "cast(l_quantity as int) as RxSup",
            "l_linenumber as RxAmt",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    def death(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 29 = 0").selectExpr(
            "case when c_custkey % 41 <> 0 then c_custkey div 3 end as PatID",
            "date_add(date'2008-06-15', cast(c_custkey % 900 as int)) as DeathDt",
            "'D' as DtImpute", "'L' as Source", "'E' as Confidence",
            "cast(c_custkey % 3 + 1 as int) as samplenum",
        )

    def source(self, name: str) -> DataFrame:
        return getattr(self, name)()

    # Raw claims feeds

    def bene(self, year: int) -> DataFrame:
        def months(k: str) -> str:
            return {
                2008: f"cast(7 * {k} % 13 as int)",
                2009: f"cast(5 * ({k} div 13) % 13 as int)",
                2010: f"cast(3 * ({k} div 7) % 13 as int)",
            }[year]

        med, drug = months("c_custkey"), months("(c_custkey + 1)")
        return self.table("customer").selectExpr(
            "concat('P', lpad(cast(c_custkey div 3 as string), 9, '0')) as DESYNPUF_ID",
            "date_add(date'1910-01-01', cast(c_custkey * 37 % 36500 as int)) as BENE_BIRTH_DT",
            "cast(c_nationkey % 4 as string) as BENE_SEX_IDENT_CD",
            "cast(c_nationkey % 6 as string) as BENE_RACE_CD",
            "concat(cast(c_nationkey % 5 as string), ' ') as SP_STATE_CODE",
            "cast(c_nationkey as string) as BENE_COUNTY_CD",
            "case when c_custkey % 29 = 0 then date_add(date'2008-06-15', cast(c_custkey % 900 as int)) end as BENE_DEATH_DT",
            f"{med} as BENE_HI_CVRAGE_TOT_MONS",
            f"least(12, {med} + cast(c_custkey % 3 as int)) as BENE_SMI_CVRAGE_TOT_MONS",
            "case when c_custkey % 6 = 0 then cast(c_custkey % 5 as int) else 0 end as BENE_HMO_CVRAGE_TOT_MONS",
            f"case when c_custkey % 101 = 0 then 'XX' else lpad(cast({drug} as string), 2, '0') end as PLAN_CVRG_MOS_NUM",
            "cast(c_custkey % 3 + 1 as int) as samplenum",
        )

    def bene_years(self) -> dict[int, DataFrame]:
        return {year: self.bene(year) for year in (2008, 2009, 2010)}

    def pde(self) -> DataFrame:
        return self.lines().selectExpr(
            "concat('P', lpad(cast(o_custkey div 3 as string), 9, '0')) as DESYNPUF_ID",
            f"date_add({CLAIM_DAY}, l_linenumber) as SRVC_DT",
            """case when l_partkey % 31 = 0 then concat('A', lpad(cast(l_partkey as string), 10, '0'))
                else lpad(cast(l_partkey as string), 11, '0') end as PROD_SRVC_ID""",
            "cast(l_quantity as int) as DAYS_SUPLY_NUM",
            "l_linenumber as QTY_DSPNSD_NUM",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
        )

    @cached_property
    def claims(self) -> DataFrame:
        """One row per order with its diagnosis and procedure code of each line number.

        Written once: raw claims are files, which every step reads anew.
        """
        # Codes have up to five characters, so they are compared as numbers of five bytes:
        # maxima of numbers are kept in a hash table, those of texts would have all lines sorted.
        at = [(kind, n) for kind in ("dx", "px") for n in range(1, 8)]
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", as_number(F.expr(DX_CODE)).alias("dx"), as_number(F.expr(PX_CODE)).alias("px"))
        wide = lines.groupBy("l_orderkey").agg(*[F.max(F.when(F.col("l_linenumber") == n, F.col(kind))).alias(f"{kind}_{n}") for kind, n in at])
        joined = self.table("orders").join(wide, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        claims = joined.selectExpr(
            "o_orderkey as k",
            "substr(o_orderpriority, 1, 1) as band",
            "concat('P', lpad(cast(o_custkey div 3 as string), 9, '0')) as DESYNPUF_ID",
            "concat('C', lpad(cast(o_orderkey as string), 12, '0')) as CLM_ID",
            f"{CLAIM_DAY} as day",
            "cast(o_custkey % 3 + 1 as int) as samplenum",
            *[f"{kind}_{n}" for kind, n in at],
        )
        return self.ws.keep(claims.withColumns({f"{kind}_{n}": as_code(f"{kind}_{n}") for kind, n in at}), "raw-claims")

    @staticmethod
    def _facility_claims(claims: DataFrame, dates: list[str]) -> DataFrame:
        """OP and IP layout; every tenth claim has a second segment."""
        return claims.selectExpr(
            "samplenum", "DESYNPUF_ID", "CLM_ID", *dates,
            "case when k % 5 = 0 then ' ' else concat('N', cast(k % 50 as string)) end as AT_PHYSN_NPI",
            "case when k % 7 = 0 then concat('S', cast(k % 20 as string)) end as OP_PHYSN_NPI",
            "case when k % 3 = 0 then '' else concat('T', cast(k % 10 as string)) end as OT_PHYSN_NPI",
            "case when k % 11 <> 0 then concat('F', cast(k % 25 as string)) end as PRVDR_NUM",
            *[f"dx_{n} as ICD9_DGNS_CD_{n}" for n in range(1, 8)],
            *[f"px_{n} as ICD9_PRCDR_CD_{n}" for n in range(1, 4)],
            *[f"px_{n} as HCPCS_CD_{n - 3}" for n in range(4, 8)],
            "explode(case when k % 10 = 0 then array(1, 2) else array(1) end) as SEGMENT",
        )

    def op(self) -> DataFrame:
        return self._facility_claims(self.claims.where("band in ('2', '3')"), ["day as CLM_FROM_DT"])

    def ip(self) -> DataFrame:
        dates = [
            "day as CLM_ADMSN_DT", "date_add(day, cast(k % 60 as int)) as NCH_BENE_DSCHRG_DT",
            "lpad(cast(k % 500 as string), 3, '0') as CLM_DRG_CD",
        ]
        return self._facility_claims(self.claims.where("band = '1'"), dates)

    def car(self) -> DataFrame:
        return self.claims.where("band in ('4', '5')").selectExpr(
            "samplenum", "DESYNPUF_ID", "CLM_ID", "day as CLM_FROM_DT",
            "case when k % 4 <> 0 then concat('N', cast(k % 50 as string)) end as PRF_PHYSN_NPI_1",
            "case when k % 6 <> 0 then concat('X', cast(k % 30 as string)) else ' ' end as TAX_NUM_1",
            *[f"dx_{n} as ICD9_DGNS_CD_{n}" for n in range(1, 5)],
            *[f"dx_{n} as LINE_ICD9_DGNS_CD_{n - 4}" for n in range(5, 8)],
            *[f"px_{n} as HCPCS_CD_{n}" for n in range(1, 8)],
        )

    def feeds(self, claims: bool = True) -> Feeds:
        return Feeds(self.bene_years(), self.pde(), **(self.claim_feeds() if claims else {}))

    def claim_feeds(self) -> dict[str, DataFrame]:
        return {"op": self.op(), "car": self.car(), "ip": self.ip()}

    def long(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [long_codes(name.upper(), df) for name, df in self.claim_feeds().items()])

    # Lookups

    def master(self) -> DataFrame:
        keys = self.table("part").selectExpr(
            "p_partkey % 400 as ka", "p_partkey % 300 as kb",
            "lpad(cast(p_partkey % 400 as string), 5, '0') as a",
            "lpad(cast(p_partkey % 300 as string), 4, '0') as b",
        )
        listed = [
            ("a", "DX", "09", "ka % 7 in (0, 1, 2)"),
            ("a", "DX", "10", "ka % 7 in (0, 4)"),
            ("a", "PX", "C4", "ka % 7 in (2, 3)"),
            ("concat('G', b)", "PX", "HC", "kb % 5 < 3"),
            ("concat('G', b)", "DX", "10", "kb % 5 in (1, 3)"),
            ("concat(b, 'F')", "DX", "09", "kb % 11 = 0"),
            ("concat(b, 'F')", "DX", "10", "kb % 11 = 0"),
            ("concat(b, 'T')", "PX", "HC", "kb % 13 = 0"),
            ("concat(b, 'T')", "PX", "09", "kb % 13 = 0"),
        ]
        rows = ", ".join(
            f"case when {test} then struct({code} as ClinCode, '{cat}' as ClinCodeCat, '{kind}' as ClinCodeType) end"
            for code, cat, kind, test in listed
        )
        return keys.selectExpr(f"inline(array({rows}))").where("ClinCode is not null").distinct()

    def code_list(self, remainder: int) -> DataFrame:
        return (
            self.table("part")
            .where(f"p_partkey % 300 % 10 = {remainder}")
            .selectExpr(
                "concat('G', lpad(cast(p_partkey % 300 as string), 4, '0')) as ClinCode",
                "'PX' as ClinCodeCat", "'HC' as ClinCodeType",
            )
            .distinct()
        )

    def code_lists(self) -> dict[str, DataFrame]:
        return {"ed": self.code_list(0), "home": self.code_list(1), "is": self.code_list(2)}

    def zips(self) -> DataFrame:
        return self.table("nation").where("n_nationkey % 5 <> 4").selectExpr(
            "concat(cast(n_regionkey as string), cast(n_nationkey as string)) as ssacd",
            "lpad(cast(n_nationkey * 37 as string), 5, '0') as ZIP",
        )

    def lookups(self) -> Lookups:
        lists = self.code_lists()
        return Lookups(self.master(), lists["ed"], lists["home"], lists["is"], self.zips())

    # Other

    def intervals(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_custkey as person", "to_date(o_orderdate) as start_dt",
            "date_add(to_date(o_orderdate), cast(30 + o_orderkey % 120 as int)) as end_dt",
            "cast(o_orderkey % 60 as int) as grace",
        )

    def stays(self) -> DataFrame:
        return self.table("orders").where("o_orderpriority like '1%'").selectExpr(
            "o_custkey as person", "o_orderkey as stay", "to_date(o_orderdate) as admit",
            "date_add(to_date(o_orderdate), cast(o_orderkey % 200 as int)) as discharge",
        )

    def visits(self) -> DataFrame:
        return self.table("orders").where("o_orderpriority like '5%'").selectExpr(
            "o_custkey as person", "to_date(o_orderdate) as visit"
        )
