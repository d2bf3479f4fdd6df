"""Plain SQL for each registered query, over the driver's tables.

Named parts are put in front of a statement as common table expressions when
its text mentions them.
"""

from __future__ import annotations

import re


PARTS: dict[str, str] = {}
_SOURCED = ("enrollment", "demographic", "dispensing", "encounter", "diagnosis", "procedure", "death")

_DX = """CASE WHEN l_partkey % 97 = 0 THEN 'OTHER' WHEN l_partkey % 89 = 0 THEN '00000'
  WHEN l_partkey % 53 = 0 THEN 'ABCDE' ELSE lpad((l_partkey % 400)::VARCHAR, 5, '0') END"""
_PX = """CASE l_suppkey % 6
  WHEN 0 THEN 'G' || lpad((l_partkey % 300)::VARCHAR, 4, '0')
  WHEN 1 THEN lpad((l_partkey % 300)::VARCHAR, 4, '0') || 'F'
  WHEN 2 THEN lpad((l_partkey % 300)::VARCHAR, 4, '0') || 'T'
  WHEN 3 THEN lpad((l_partkey % 400)::VARCHAR, 5, '0')
  WHEN 4 THEN lpad((l_partkey % 90)::VARCHAR, 3, '0')
  ELSE 'O' || lpad((l_partkey % 300)::VARCHAR, 4, '0') END"""
_ENC = """CASE substr(o_orderpriority, 1, 1)
  WHEN '1' THEN 'IP' WHEN '2' THEN 'ED' WHEN '3' THEN 'IS' WHEN '4' THEN 'AV' ELSE 'OA' END"""
_PAT = "CASE WHEN o_custkey % 41 <> 0 THEN o_custkey // 3 END AS PatID"
_ENCID = "CASE WHEN o_orderkey % 37 <> 0 THEN o_orderkey END AS EncounterID"
_SAMPLE = "(o_custkey % 3 + 1)::INTEGER AS samplenum"
_PERSON = "'P' || lpad((o_custkey // 3)::VARCHAR, 9, '0') AS DESYNPUF_ID"
_DAY = "DATE '2007-12-15' + (o_orderkey * 7 % 1140)::INTEGER"

# Common-model sources

PARTS["s_demographic"] = """SELECT CASE WHEN c_custkey % 41 <> 0 THEN c_custkey // 3 END AS PatID,
  DATE '1910-01-01' + (c_custkey * 37 % 36500)::INTEGER AS Birth_Date,
  CASE c_nationkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'U' ELSE 'A' END AS Sex,
  CASE c_nationkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END AS Hispanic,
  (c_nationkey % 6)::VARCHAR AS Race,
  CASE WHEN c_nationkey % 5 <> 4 THEN lpad((c_nationkey * 37)::VARCHAR, 5, '0') END AS PostalCode,
  DATE '2008-01-01' + (c_custkey % 365)::INTEGER AS PostalCode_Date,
  NULL::VARCHAR AS ImputedRace, NULL::VARCHAR AS ImputedHispanic,
  (c_custkey % 3 + 1)::INTEGER AS samplenum FROM customer"""
PARTS["s_enrollment"] = f"""SELECT {_PAT}, o_orderdate::DATE AS Enr_Start,
  o_orderdate::DATE + (30 + o_orderkey % 120)::INTEGER AS Enr_End,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS MedCov,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Y' ELSE 'N' END AS DrugCov, 'N' AS Chart,
  NULL::VARCHAR AS PlanType, NULL::VARCHAR AS PayerType, {_SAMPLE} FROM orders"""
PARTS["s_encounter"] = f"""SELECT {_PAT}, {_ENCID}, o_orderdate::DATE AS ADate,
  o_orderdate::DATE + (o_orderkey % 200)::INTEGER AS DDate, {_ENC} AS EncType,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 25 END AS FacilityID,
  (o_orderkey % 4)::VARCHAR AS Discharge_Disposition, (o_orderkey % 7)::VARCHAR AS Discharge_Status,
  lpad((o_orderkey % 500)::VARCHAR, 3, '0') AS DRG, '2' AS DRG_Type,
  (o_orderkey % 5)::VARCHAR AS Admitting_Source, {_SAMPLE} FROM orders"""
PARTS["s_provider"] = "SELECT s_suppkey // 3 AS ProviderID, (s_suppkey % 3 + 1)::INTEGER AS samplenum FROM supplier"
PARTS["s_facility"] = "SELECT n_nationkey::BIGINT AS FacilityID, (n_nationkey % 3 + 1)::INTEGER AS samplenum FROM nation"
PARTS["s_diagnosis"] = f"""SELECT {_PAT}, {_ENCID}, o_orderdate::DATE AS ADate, l_suppkey // 3 AS ProviderID,
  {_ENC} AS EncType, {_DX} AS DX, '09' AS Dx_Codetype, {_DX} AS OrigDX,
  CASE WHEN l_linenumber = 1 THEN 'P' ELSE 'S' END AS PDX, 'U' AS PAdmit, {_SAMPLE}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
PARTS["s_procedure"] = f"""SELECT {_PAT}, {_ENCID}, o_orderdate::DATE AS ADate, l_suppkey // 3 AS ProviderID,
  {_ENC} AS EncType, {_PX} AS PX, 'C4' AS PX_CodeType, {_PX} AS OrigPX, {_SAMPLE}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
PARTS["s_dispensing"] = f"""SELECT {_PAT}, l_suppkey AS ProviderID, l_shipdate::DATE AS RxDate,
  lpad(l_partkey::VARCHAR, 11, '0') AS Rx, 'ND' AS Rx_CodeType, l_quantity::INTEGER AS RxSup,
  l_linenumber AS RxAmt, {_SAMPLE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
PARTS["s_death"] = """SELECT CASE WHEN c_custkey % 41 <> 0 THEN c_custkey // 3 END AS PatID,
  DATE '2008-06-15' + (c_custkey % 900)::INTEGER AS DeathDt, 'D' AS DtImpute, 'L' AS Source, 'E' AS Confidence,
  (c_custkey % 3 + 1)::INTEGER AS samplenum FROM customer WHERE c_custkey % 29 = 0"""

PARTS["cw_patid"] = """SELECT orig_PatID, samplenum,
  row_number() OVER (ORDER BY samplenum, orig_PatID) AS PatID
  FROM (SELECT DISTINCT PatID AS orig_PatID, samplenum FROM s_demographic WHERE PatID IS NOT NULL)"""
PARTS["cw_encounterid"] = """SELECT orig_EncounterID, samplenum,
  row_number() OVER (ORDER BY samplenum, orig_EncounterID) AS EncounterID
  FROM (SELECT DISTINCT EncounterID AS orig_EncounterID, samplenum FROM s_encounter WHERE EncounterID IS NOT NULL)"""
PARTS["cw_providerid"] = """SELECT orig_ProviderID, samplenum,
  row_number() OVER (ORDER BY samplenum, orig_ProviderID) AS ProviderID
  FROM (SELECT DISTINCT ProviderID AS orig_ProviderID, samplenum FROM s_provider WHERE ProviderID IS NOT NULL)"""
PARTS["cw_facilityid"] = """SELECT orig_FacilityID, samplenum,
  row_number() OVER (ORDER BY samplenum, orig_FacilityID) AS FacilityID
  FROM (SELECT DISTINCT FacilityID AS orig_FacilityID, samplenum FROM s_facility WHERE FacilityID IS NOT NULL)"""
PARTS["t_enrollment"] = """SELECT patid_x.PatID, a.Enr_Start, a.Enr_End, a.MedCov, a.DrugCov, a.Chart, a.PlanType, a.PayerType FROM s_enrollment
  a INNER JOIN cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND a.samplenum = patid_x.samplenum"""
PARTS["t_demographic"] = """SELECT patid_x.PatID, a.Birth_Date, a.Sex, a.Hispanic, a.Race, a.PostalCode, a.PostalCode_Date, a.ImputedRace,
  a.ImputedHispanic FROM s_demographic a INNER JOIN cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND a.samplenum =
  patid_x.samplenum"""
PARTS["t_dispensing"] = """SELECT patid_x.PatID, a.ProviderID, a.RxDate, a.Rx, a.Rx_CodeType, a.RxSup, a.RxAmt FROM s_dispensing a INNER JOIN
  cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND a.samplenum = patid_x.samplenum"""
PARTS["t_encounter"] = """SELECT patid_x.PatID, encounterid_x.EncounterID, a.ADate, a.DDate, a.EncType, facilityid_x.FacilityID,
  a.Discharge_Disposition, a.Discharge_Status, a.DRG, a.DRG_Type, a.Admitting_Source FROM s_encounter a INNER JOIN
  cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND a.samplenum = patid_x.samplenum LEFT JOIN cw_encounterid
  encounterid_x ON a.EncounterID = encounterid_x.orig_EncounterID AND a.samplenum = encounterid_x.samplenum LEFT JOIN
  cw_facilityid facilityid_x ON a.FacilityID = facilityid_x.orig_FacilityID AND a.samplenum = facilityid_x.samplenum"""
PARTS["t_diagnosis"] = """SELECT patid_x.PatID, encounterid_x.EncounterID, a.ADate, providerid_x.ProviderID, a.EncType, a.DX, a.Dx_Codetype,
  a.OrigDX, a.PDX, a.PAdmit FROM s_diagnosis a INNER JOIN cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND
  a.samplenum = patid_x.samplenum LEFT JOIN cw_encounterid encounterid_x ON a.EncounterID =
  encounterid_x.orig_EncounterID AND a.samplenum = encounterid_x.samplenum LEFT JOIN cw_providerid providerid_x ON
  a.ProviderID = providerid_x.orig_ProviderID AND a.samplenum = providerid_x.samplenum"""
PARTS["t_procedure"] = """SELECT patid_x.PatID, encounterid_x.EncounterID, a.ADate, providerid_x.ProviderID, a.EncType, a.PX, a.PX_CodeType,
  a.OrigPX FROM s_procedure a INNER JOIN cw_patid patid_x ON a.PatID = patid_x.orig_PatID AND a.samplenum =
  patid_x.samplenum LEFT JOIN cw_encounterid encounterid_x ON a.EncounterID = encounterid_x.orig_EncounterID AND
  a.samplenum = encounterid_x.samplenum LEFT JOIN cw_providerid providerid_x ON a.ProviderID =
  providerid_x.orig_ProviderID AND a.samplenum = providerid_x.samplenum"""
PARTS["t_death"] = """SELECT patid_x.PatID, a.DeathDt, a.DtImpute, a.Source, a.Confidence FROM s_death a INNER JOIN cw_patid patid_x ON
  a.PatID = patid_x.orig_PatID AND a.samplenum = patid_x.samplenum"""
PARTS["t_provider"] = "SELECT ProviderID, '99' AS Specialty, '2' AS Specialty_CodeType FROM cw_providerid"
PARTS["t_facility"] = "SELECT FacilityID, '' AS Facility_Location FROM cw_facilityid"

# Raw claims feeds


def _months(k: str, year: int) -> str:
    return {2008: f"(7 * {k} % 13)::INTEGER", 2009: f"(5 * ({k} // 13) % 13)::INTEGER", 2010: f"(3 * ({k} // 7) % 13)::INTEGER"}[year]


def _bene(year: int) -> str:
    med, drug = _months("c_custkey", year), _months("(c_custkey + 1)", year)
    return f"""SELECT {year} AS YEAR, 'P' || lpad((c_custkey // 3)::VARCHAR, 9, '0') AS DESYNPUF_ID,
  DATE '1910-01-01' + (c_custkey * 37 % 36500)::INTEGER AS BENE_BIRTH_DT,
  (c_nationkey % 4)::VARCHAR AS BENE_SEX_IDENT_CD, (c_nationkey % 6)::VARCHAR AS BENE_RACE_CD,
  (c_nationkey % 5)::VARCHAR || ' ' AS SP_STATE_CODE, c_nationkey::VARCHAR AS BENE_COUNTY_CD,
  CASE WHEN c_custkey % 29 = 0 THEN DATE '2008-06-15' + (c_custkey % 900)::INTEGER END AS BENE_DEATH_DT,
  {med} AS BENE_HI_CVRAGE_TOT_MONS,
  least(12, {med} + (c_custkey % 3)::INTEGER) AS BENE_SMI_CVRAGE_TOT_MONS,
  CASE WHEN c_custkey % 6 = 0 THEN (c_custkey % 5)::INTEGER ELSE 0 END AS BENE_HMO_CVRAGE_TOT_MONS,
  CASE WHEN c_custkey % 101 = 0 THEN 'XX' ELSE lpad(({drug})::VARCHAR, 2, '0') END AS PLAN_CVRG_MOS_NUM,
  (c_custkey % 3 + 1)::INTEGER AS samplenum FROM customer"""


PARTS["bene"] = " UNION ALL ".join(_bene(y) for y in (2008, 2009, 2010))
PARTS["pde"] = f"""SELECT {_PERSON}, {_DAY} + l_linenumber AS SRVC_DT,
  CASE WHEN l_partkey % 31 = 0 THEN 'A' || lpad(l_partkey::VARCHAR, 10, '0') ELSE lpad(l_partkey::VARCHAR, 11, '0') END AS PROD_SRVC_ID,
  l_quantity::INTEGER AS DAYS_SUPLY_NUM, l_linenumber AS QTY_DSPNSD_NUM, {_SAMPLE}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
PARTS["wide"] = (
    "SELECT l_orderkey, "
    + ", ".join(
        f"max(CASE WHEN l_linenumber = {n} THEN {code} END) AS {kind}_{n}" for kind, code in (("dx", _DX), ("px", _PX)) for n in range(1, 8)
    )
    + " FROM lineitem GROUP BY l_orderkey"
)
PARTS["claims"] = f"""SELECT o_orderkey AS k, substr(o_orderpriority, 1, 1) AS band,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'IP' WHEN '2' THEN 'OP' WHEN '3' THEN 'OP' ELSE 'CAR' END AS feed,
  {_PERSON}, 'C' || lpad(o_orderkey::VARCHAR, 12, '0') AS CLM_ID, {_DAY} AS clm_day, {_SAMPLE}, wide.*
  FROM orders LEFT JOIN wide ON o_orderkey = l_orderkey"""


def _lines() -> str:
    """One select per code column of each feed; a second segment repeats a claim's lines."""
    out = []
    slots = {
        "('OP', 'IP')": [("icd9_dgns_cd", n, "DX", f"dx_{n}") for n in range(1, 8)]
        + [("icd9_prcdr_cd", n, "PX", f"px_{n}") for n in range(1, 4)]
        + [("hcpcs_cd", n - 3, "PX", f"px_{n}") for n in range(4, 8)],
        "('CAR')": [("icd9_dgns_cd", n, "DX", f"dx_{n}") for n in range(1, 5)]
        + [("line_icd9_dgns_cd", n - 4, "DX", f"dx_{n}") for n in range(5, 8)]
        + [("hcpcs_cd", n, "PX", f"px_{n}") for n in range(1, 8)],
    }
    for feeds, cols in slots.items():
        for var, num, cat, col in cols:
            out.append(f"SELECT k, feed, samplenum, DESYNPUF_ID, CLM_ID, {col} AS raw, '{cat}' AS sourcecat, '{var}' AS sourcevar, {num} AS sourcevarnum FROM claims WHERE feed IN {feeds}")
    return " UNION ALL ".join(out)


PARTS["px_typed"] = _lines()
PARTS["long"] = """SELECT samplenum, feed, DESYNPUF_ID AS PatID, CLM_ID AS EncounterID, replace(raw, 'O', '0') AS sourcecode, sourcecat,
  CASE WHEN sourcecat = 'DX' THEN '09'
    WHEN regexp_matches(replace(raw, 'O', '0')[1:1], '[A-Za-z]') THEN 'HC' WHEN length(raw) < 5 THEN '09'
    WHEN raw[5:5] = 'F' THEN 'C2' WHEN raw[5:5] = 'T' THEN 'C3' ELSE 'C4' END AS sourcetype, sourcevar, sourcevarnum
  FROM px_typed, (SELECT 1 AS seg UNION ALL SELECT 2)
  WHERE (seg = 1 OR (feed <> 'CAR' AND k % 10 = 0)) AND regexp_matches(raw, '[A-Za-z0-9]')
    AND replace(raw, 'O', '0') NOT IN ('0THER', 'XX000', '00000', 'XXXXX', 'T0TAL') AND regexp_matches(replace(raw, 'O', '0'), '[0-9]')"""

# Lookups

PARTS["part_keys"] = """SELECT p_partkey % 400 AS ka, p_partkey % 300 AS kb, lpad((p_partkey % 400)::VARCHAR, 5, '0') AS a,
  lpad((p_partkey % 300)::VARCHAR, 4, '0') AS b FROM part"""
PARTS["master"] = """SELECT a AS ClinCode, 'DX' AS ClinCodeCat, '09' AS ClinCodeType FROM part_keys WHERE ka % 7 IN (0, 1, 2)
  UNION SELECT a, 'DX', '10' FROM part_keys WHERE ka % 7 IN (0, 4)
  UNION SELECT a, 'PX', 'C4' FROM part_keys WHERE ka % 7 IN (2, 3)
  UNION SELECT 'G' || b, 'PX', 'HC' FROM part_keys WHERE kb % 5 < 3
  UNION SELECT 'G' || b, 'DX', '10' FROM part_keys WHERE kb % 5 IN (1, 3)
  UNION SELECT b || 'F', 'DX', '09' FROM part_keys WHERE kb % 11 = 0
  UNION SELECT b || 'F', 'DX', '10' FROM part_keys WHERE kb % 11 = 0
  UNION SELECT b || 'T', 'PX', 'HC' FROM part_keys WHERE kb % 13 = 0
  UNION SELECT b || 'T', 'PX', '09' FROM part_keys WHERE kb % 13 = 0"""
for _list, _rem in (("ed", 0), ("home", 1), ("inst", 2)):
    PARTS[f"list_{_list}"] = f"SELECT DISTINCT 'G' || b AS ClinCode, 'HC' AS ClinCodeType FROM part_keys WHERE kb % 10 = {_rem}"
PARTS["zips"] = """SELECT n_regionkey::VARCHAR || n_nationkey::VARCHAR AS ssacd, lpad((n_nationkey * 37)::VARCHAR, 5, '0') AS ZIP
  FROM nation WHERE n_nationkey % 5 <> 4"""

# Code resolution

PARTS["counted"] = """SELECT samplenum, feed, sourcecode, sourcecat, sourcetype, count(DISTINCT EncounterID) AS clm_count
  FROM long GROUP BY ALL"""
PARTS["linked"] = "SELECT c.*, m.ClinCodeCat, m.ClinCodeType FROM counted c LEFT JOIN master m ON c.sourcecode = m.ClinCode"
PARTS["kinds"] = """SELECT samplenum, feed, sourcecode, count(DISTINCT ClinCodeCat || ClinCodeType) AS real_code_count,
  count(DISTINCT sourcecat || sourcetype) AS source_code_count FROM linked GROUP BY ALL"""
PARTS["matched"] = """SELECT l.*, k.real_code_count, k.source_code_count,
  CASE WHEN source_code_count = 1 AND real_code_count = 1 THEN '1:1' WHEN source_code_count > 1 AND real_code_count = 1 THEN 'MANY:1'
    WHEN source_code_count = 1 AND real_code_count > 1 THEN '1:MANY' WHEN source_code_count > 1 AND real_code_count > 1 THEN 'MANY:MANY'
    WHEN source_code_count = 1 THEN '1:0' ELSE 'MANY:0' END AS match_type
  FROM linked l JOIN kinds k USING (samplenum, feed, sourcecode)"""
PARTS["placed"] = """SELECT samplenum, feed, sourcecode, sourcecat, sourcetype, ClinCodeCat, ClinCodeType, match_type,
  CASE WHEN match_type = '1:0' THEN '1' WHEN match_type = 'MANY:0' THEN '2' WHEN match_type = '1:1' THEN '3'
    WHEN match_type = 'MANY:1' THEN '4'
    ELSE (CASE match_type WHEN '1:MANY' THEN '5' ELSE '6' END) || (CASE WHEN sourcecat = ClinCodeCat AND sourcetype = ClinCodeType THEN '.1'
      WHEN sourcecat = ClinCodeCat THEN '.2' ELSE '.3' END) END AS step,
  CASE WHEN match_type IN ('1:0', 'MANY:0') THEN sourcecat ELSE ClinCodeCat END AS cat,
  CASE WHEN match_type IN ('1:0', 'MANY:0') THEN 'OT' ELSE ClinCodeType END AS type FROM matched"""
PARTS["unmatched"] = """SELECT * FROM placed p WHERE step IN ('5.3', '6.3') AND NOT EXISTS (SELECT 1 FROM placed q
  WHERE q.step NOT IN ('5.3', '6.3') AND q.samplenum = p.samplenum AND q.feed = p.feed AND q.sourcecode = p.sourcecode)"""
PARTS["decided"] = """SELECT p.samplenum, p.feed, p.sourcecode, p.sourcecat, p.sourcetype, p.ClinCodeCat, p.ClinCodeType, p.cat, p.type, p.step,
  CASE WHEN p.step NOT IN ('5.3', '6.3') THEN p.cat WHEN u.sourcecode IS NOT NULL THEN p.cat ELSE 'LEFT' END AS route
  FROM placed p LEFT JOIN (SELECT DISTINCT samplenum, feed, sourcecode FROM unmatched) u USING (samplenum, feed, sourcecode)"""


def _coded(route: str) -> str:
    return f"""SELECT l.samplenum, l.feed, l.PatID, l.EncounterID, l.sourcecode AS code, d.type AS codetype,
  min(CASE WHEN l.sourcevarnum = 1 AND l.sourcecat = 'DX' THEN 'P' ELSE 'S' END) AS flag
  FROM decided d JOIN long l USING (samplenum, feed, sourcecode, sourcecat, sourcetype) WHERE d.route = '{route}' GROUP BY ALL"""


PARTS["coded_dx"], PARTS["coded_px"] = _coded("DX"), _coded("PX")
PARTS["dx"] = """SELECT samplenum, feed, PatID, EncounterID, code AS DX, codetype AS Dx_Codetype, code AS OrigDX,
  CASE WHEN feed = 'IP' THEN flag END AS PDX, 'U' AS PAdmit FROM coded_dx"""
PARTS["px"] = "SELECT samplenum, feed, PatID, EncounterID, code AS PX, codetype AS PX_CodeType, code AS OrigPX FROM coded_px"
PARTS["flags"] = """SELECT p.samplenum, p.feed, p.PatID, p.EncounterID, max(e.ClinCode IS NOT NULL) AS ind_ed,
  max(h.ClinCode IS NOT NULL) AS ind_home, max(i.ClinCode IS NOT NULL) AS ind_is
  FROM px p LEFT JOIN list_ed e ON p.PX = e.ClinCode AND p.PX_CodeType = e.ClinCodeType
  LEFT JOIN list_home h ON p.PX = h.ClinCode AND p.PX_CodeType = h.ClinCodeType
  LEFT JOIN list_inst i ON p.PX = i.ClinCode AND p.PX_CodeType = i.ClinCodeType GROUP BY ALL"""

# Encounters

PARTS["facility_claims"] = """SELECT c.*, coalesce(CASE WHEN k % 5 <> 0 THEN 'N' || (k % 50)::VARCHAR END,
  CASE WHEN k % 7 = 0 THEN 'S' || (k % 20)::VARCHAR END, CASE WHEN k % 3 <> 0 THEN 'T' || (k % 10)::VARCHAR END,
  CASE WHEN k % 11 <> 0 THEN 'F' || (k % 25)::VARCHAR END, 'UNKNOWN') AS prov FROM claims c WHERE feed IN ('OP', 'IP')"""
_EMPTY = """NULL::VARCHAR AS Facility_Code, NULL::VARCHAR AS Discharge_Disposition, NULL::VARCHAR AS Discharge_Status,
  NULL::VARCHAR AS DRG, NULL::VARCHAR AS DRG_Type, NULL::VARCHAR AS Admitting_Source"""
PARTS["enc_op"] = f"""SELECT DISTINCT c.samplenum, c.feed, c.DESYNPUF_ID AS PatID, c.CLM_ID AS EncounterID, clm_day AS ADate, NULL::DATE AS DDate,
  prov AS Provider, CASE WHEN f.ind_ed THEN 'ED' WHEN f.ind_home OR f.ind_is THEN 'OA' ELSE 'AV' END AS EncType, {_EMPTY}
  FROM facility_claims c LEFT JOIN flags f ON f.samplenum = c.samplenum AND f.feed = c.feed AND f.PatID = c.DESYNPUF_ID AND f.EncounterID = c.CLM_ID
  WHERE c.feed = 'OP'"""
PARTS["enc_car"] = f"""SELECT DISTINCT c.samplenum, c.feed, c.DESYNPUF_ID AS PatID, c.CLM_ID AS EncounterID, clm_day AS ADate, NULL::DATE AS DDate,
  coalesce(CASE WHEN k % 4 <> 0 THEN 'N' || (k % 50)::VARCHAR END, CASE WHEN k % 6 <> 0 THEN 'X' || (k % 30)::VARCHAR END, 'UNKNOWN') AS Provider,
  CASE WHEN f.ind_home OR f.ind_is THEN 'OA' ELSE 'AV' END AS EncType, {_EMPTY}
  FROM claims c LEFT JOIN flags f ON f.samplenum = c.samplenum AND f.feed = c.feed AND f.PatID = c.DESYNPUF_ID AND f.EncounterID = c.CLM_ID
  WHERE c.feed = 'CAR'"""
PARTS["oa_visits"] = "SELECT DISTINCT samplenum, PatID, ADate FROM (SELECT * FROM enc_op UNION ALL SELECT * FROM enc_car) WHERE EncType = 'OA'"
PARTS["enc_ip"] = """SELECT DISTINCT c.samplenum, c.feed, c.DESYNPUF_ID AS PatID, c.CLM_ID AS EncounterID, clm_day AS ADate,
  clm_day + (k % 60)::INTEGER AS DDate, prov AS Provider,
  CASE WHEN v.ADate IS NOT NULL AND k % 60 > 2 THEN 'IS' ELSE 'IP' END AS EncType,
  CASE WHEN k % 11 <> 0 THEN 'F' || (k % 25)::VARCHAR END AS Facility_Code, 'U' AS Discharge_Disposition, 'UN' AS Discharge_Status,
  lpad((k % 500)::VARCHAR, 3, '0') AS DRG, '2' AS DRG_Type, 'UN' AS Admitting_Source
  FROM facility_claims c LEFT JOIN oa_visits v ON v.samplenum = c.samplenum AND v.PatID = c.DESYNPUF_ID
    AND v.ADate BETWEEN clm_day AND clm_day + (k % 60)::INTEGER
  WHERE c.feed = 'IP'"""
PARTS["headers"] = "SELECT * FROM enc_op UNION ALL SELECT * FROM enc_car UNION ALL SELECT * FROM enc_ip"

# Enrolment


def _year_sums() -> str:
    sums = ["min(BENE_DEATH_DT) AS death_dt"]
    for col, out in (
        ("BENE_HI_CVRAGE_TOT_MONS", "a"), ("BENE_SMI_CVRAGE_TOT_MONS", "b"), ("BENE_HMO_CVRAGE_TOT_MONS", "hmo"),
        ("try_cast(trim(PLAN_CVRG_MOS_NUM) AS INTEGER)", "drugcov"),
    ):
        sums += [f"sum((YEAR = {y})::INTEGER * {col})::BIGINT AS {out}_{y}" for y in (2008, 2009, 2010)]
    return f"SELECT samplenum, DESYNPUF_ID AS PatID, {', '.join(sums)} FROM bene GROUP BY ALL"


PARTS["year_sums"] = _year_sums()
PARTS["summary"] = "SELECT *, " + ", ".join(
    f"least(a_{y}, b_{y}) AS ab_{y}, least(a_{y}, b_{y}, 12 - hmo_{y}) AS medcov_{y}" for y in (2008, 2009, 2010)
) + " FROM year_sums"
PARTS["months"] = """SELECT samplenum, PatID, 'Med' AS kind, death_dt AS d, medcov_2008 AS m08, medcov_2009 AS m09, medcov_2010 AS m10 FROM summary
  UNION ALL SELECT samplenum, PatID, 'Drug', death_dt, drugcov_2008, drugcov_2009, drugcov_2010 FROM summary"""


def _to(year: int, m: str) -> str:
    return f"last_day((DATE '{year - 1}-12-01' + to_months({m}::INTEGER))::DATE)"


def _back(year: int, m: str) -> str:
    return f"(DATE '{year + 1}-01-01' - to_months({m}::INTEGER))::DATE"


_FALL = "coalesce(m08, -1) >= coalesce(m10, -1)"
_ONE = "(coalesce(year(d) = 2008, false) OR coalesce(coalesce(m09, m10 - m10) + coalesce(m10, m09 - m09) = 0, false))"
PARTS["cov"] = f"""SELECT samplenum, PatID, kind, Enr_Start, Enr_End FROM (
  SELECT samplenum, PatID, kind, DATE '2008-01-01' AS Enr_Start, least(d, {_to(2008, 'm08')}) AS Enr_End FROM months WHERE {_FALL} AND {_ONE}
  UNION ALL SELECT samplenum, PatID, kind, {_back(2008, 'm08')}, DATE '2008-12-31' FROM months WHERE {_FALL} AND NOT {_ONE}
  UNION ALL SELECT samplenum, PatID, kind, DATE '2009-01-01', least(d, {_to(2009, 'm09')}) FROM months WHERE {_FALL} AND NOT {_ONE}
  UNION ALL SELECT samplenum, PatID, kind, {_back(2009, 'm09')}, DATE '2009-12-31' FROM months WHERE NOT {_FALL}
  UNION ALL SELECT samplenum, PatID, kind, DATE '2008-01-01', {_to(2008, 'm08')} FROM months WHERE NOT {_FALL} AND coalesce(m09, -1) < 12
  UNION ALL SELECT samplenum, PatID, kind, {_back(2008, 'm08')}, DATE '2008-12-31' FROM months WHERE NOT {_FALL} AND coalesce(m09, -1) >= 12
  UNION ALL SELECT samplenum, PatID, kind, DATE '2010-01-01', least(d, {_to(2010, 'm10')}) FROM months WHERE m10 > 0)
  WHERE Enr_Start < Enr_End"""


def _islands(source: str, by: str, start: str, end: str, grace: str, previous: str | None = None) -> str:
    order = f"PARTITION BY {by} ORDER BY {start}, {end}"
    previous = previous or f"lag({end}) OVER ({order})"
    return f"""SELECT {by}, min({start}) AS {start}_span, max({end}) AS {end}_span,
  date_diff('day', min({start}), max({end})) + 1 AS SPAN_DAYS FROM (
    SELECT *, sum(opens) OVER ({order} ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN prev IS NULL OR date_diff('day', prev, {start}) - 1 > {grace} THEN 1 ELSE 0 END AS opens FROM (
        SELECT *, {previous} AS prev FROM {source} WHERE {end} >= {start})))
  GROUP BY {by}, island"""


PARTS["cov_spans"] = _islands("cov", "samplenum, PatID, kind", "Enr_Start", "Enr_End", "0")


def _timeline(source: str, by: str, start: str, end: str, last: str, kinds: dict[str, str]) -> str:
    on = " AND ".join(f"p.{c.strip()} = s.{c.strip()}" for c in by.split(","))
    cols = ", ".join(f"p.{c.strip()}" for c in by.split(","))
    flags = ", ".join(f"coalesce(max(CASE WHEN s.kind = '{k}' THEN 'Y' END), 'N') AS {out}" for k, out in kinds.items())
    return f"""SELECT {cols}, p.PeriodStart, p.PeriodEnd, {flags} FROM (
    SELECT {by}, t AS PeriodStart, coalesce(lead(t) OVER (PARTITION BY {by} ORDER BY t) - 1, DATE '{last}') AS PeriodEnd FROM (
      SELECT {by}, {start} AS t FROM {source} UNION SELECT {by}, {end} + 1 FROM {source} WHERE {end} <> DATE '{last}')) p
  JOIN {source} s ON {on} AND p.PeriodEnd >= s.{start} AND s.{end} >= p.PeriodStart GROUP BY ALL"""


PARTS["periods"] = _timeline("cov_spans", "samplenum, PatID", "Enr_Start_span", "Enr_End_span", "2010-12-31", {"Med": "MedCov", "Drug": "DrugCov"})
PARTS["enr"] = "SELECT samplenum, PatID, PeriodStart AS Enr_Start, PeriodEnd AS Enr_End, MedCov, DrugCov, 'N' AS Chart FROM periods"
PARTS["demo"] = """SELECT DISTINCT samplenum, DESYNPUF_ID AS PatID, BENE_BIRTH_DT AS Birth_Date,
  CASE BENE_SEX_IDENT_CD WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE 'U' END AS Sex,
  CASE BENE_RACE_CD WHEN '5' THEN 'Y' WHEN '1' THEN 'N' ELSE 'U' END AS Hispanic,
  CASE BENE_RACE_CD WHEN '1' THEN '5' WHEN '2' THEN '3' ELSE '0' END AS Race, ZIP
  FROM bene LEFT JOIN zips ON trim(SP_STATE_CODE) || trim(BENE_COUNTY_CD) = ssacd"""
PARTS["deaths"] = """SELECT DISTINCT samplenum, DESYNPUF_ID AS PatID, BENE_DEATH_DT AS DeathDt, 'D' AS DtImpute, 'L' AS Source, 'E' AS Confidence
  FROM bene WHERE BENE_DEATH_DT IS NOT NULL"""
PARTS["disp"] = """SELECT samplenum, DESYNPUF_ID AS PatID, SRVC_DT AS RxDate, PROD_SRVC_ID AS NDC, sum(DAYS_SUPLY_NUM)::BIGINT AS RxSup,
  sum(QTY_DSPNSD_NUM)::BIGINT AS RxAmt FROM pde WHERE NOT regexp_matches(PROD_SRVC_ID, '[A-Za-z]') GROUP BY ALL"""

# Final tables of the translation: ids restart in each subsample

PARTS["firsts"] = "SELECT samplenum, PatID, min(Enr_Start) AS first_enr_dt FROM enr GROUP BY ALL"
PARTS["f_people"] = "SELECT samplenum, PatID AS orig, first_enr_dt, row_number() OVER (PARTITION BY samplenum ORDER BY PatID) AS id FROM firsts"
PARTS["f_headers"] = "SELECT * FROM headers WHERE ADate BETWEEN DATE '2008-01-01' AND DATE '2010-12-31'"
for _part, _col in (("f_enc", "EncounterID"), ("f_fac", "Facility_Code"), ("f_prov", "Provider")):
    PARTS[_part] = f"""SELECT samplenum, orig, row_number() OVER (PARTITION BY samplenum ORDER BY orig) AS id
  FROM (SELECT DISTINCT samplenum, {_col} AS orig FROM f_headers WHERE {_col} IS NOT NULL)"""
_P = "JOIN f_people p ON p.samplenum = a.samplenum AND p.orig = a.PatID"
PARTS["f_enrollment"] = f"""SELECT DISTINCT a.samplenum, p.id AS PatID, Enr_Start, Enr_End, MedCov, DrugCov, Chart,
  NULL::VARCHAR AS PlanType, NULL::VARCHAR AS PayerType FROM enr a {_P}"""
PARTS["f_demographic"] = f"""SELECT DISTINCT a.samplenum, p.id AS PatID, Birth_Date, Sex, Hispanic, Race, ZIP AS PostalCode,
  CASE WHEN ZIP IS NOT NULL THEN p.first_enr_dt END AS PostalCode_Date, NULL::VARCHAR AS ImputedRace, NULL::VARCHAR AS ImputedHispanic FROM demo a {_P}"""
PARTS["f_dispensing"] = f"""SELECT DISTINCT a.samplenum, p.id AS PatID, NULL::BIGINT AS ProviderID, RxDate, NDC AS Rx, 'ND' AS Rx_CodeType, RxSup, RxAmt
  FROM disp a {_P}"""
PARTS["f_death"] = f"SELECT DISTINCT a.samplenum, p.id AS PatID, DeathDt, DtImpute, Source, Confidence FROM deaths a {_P}"
PARTS["f_encounter"] = f"""SELECT DISTINCT a.samplenum, p.id AS PatID, e.id AS EncounterID, ADate, DDate, EncType, f.id AS FacilityID,
  Discharge_Disposition, Discharge_Status, DRG, DRG_Type, Admitting_Source FROM f_headers a {_P}
  LEFT JOIN f_enc e ON e.samplenum = a.samplenum AND e.orig = a.EncounterID
  LEFT JOIN f_fac f ON f.samplenum = a.samplenum AND f.orig = a.Facility_Code"""


def _final_detail(lines: str, cols: str) -> str:
    return f"""SELECT DISTINCT a.samplenum, p.id AS PatID, e.id AS EncounterID, h.ADate, v.id AS ProviderID, h.EncType, {cols}
  FROM {lines} a {_P} JOIN f_headers h ON h.samplenum = a.samplenum AND h.feed = a.feed AND h.EncounterID = a.EncounterID
  LEFT JOIN f_enc e ON e.samplenum = a.samplenum AND e.orig = a.EncounterID
  LEFT JOIN f_prov v ON v.samplenum = a.samplenum AND v.orig = h.Provider"""


PARTS["f_diagnosis"] = _final_detail("dx", "DX, Dx_Codetype, OrigDX, PDX, PAdmit")
PARTS["f_procedure"] = _final_detail("px", "PX, PX_CodeType, OrigPX")
PARTS["f_provider"] = "SELECT samplenum, id AS ProviderID, '99' AS Specialty, '2' AS Specialty_CodeType FROM f_prov"
PARTS["f_facility"] = "SELECT samplenum, id AS FacilityID, '' AS Facility_Location FROM f_fac"

# Plain intervals

for _n in _SOURCED:
    PARTS[f"x_{_n}"] = f"SELECT * FROM s_{_n}"
PARTS["x_provider"] = """SELECT s_suppkey // 3 AS ProviderID, '00' AS Specialty, '1' AS Specialty_CodeType,
  (s_suppkey % 3 + 1)::INTEGER AS samplenum FROM supplier"""
PARTS["x_facility"] = "SELECT n_nationkey AS FacilityID, n_name AS Facility_Location, (n_nationkey % 3 + 1)::INTEGER AS samplenum FROM nation"
PARTS["k_dispensing"] = "SELECT * REPLACE ('K' || lpad(ProviderID::VARCHAR, 12, '0') AS ProviderID) FROM t_dispensing"
for _part, _table, _id in (
    ("c_pat", "f_demographic", "PatID"), ("c_enc", "f_encounter", "EncounterID"),
    ("c_prov", "f_provider", "ProviderID"), ("c_fac", "f_facility", "FacilityID"),
):
    PARTS[_part] = f"""SELECT samplenum, orig, row_number() OVER (ORDER BY samplenum, orig) AS id
  FROM (SELECT DISTINCT samplenum, {_id} AS orig FROM {_table} WHERE {_id} IS NOT NULL)"""

PARTS["spells"] = """SELECT o_custkey AS person, o_orderdate::DATE AS start_dt,
  o_orderdate::DATE + (30 + o_orderkey % 120)::INTEGER AS end_dt, (o_orderkey % 60)::INTEGER AS grace FROM orders"""
PARTS["stays"] = """SELECT o_custkey AS person, o_orderkey AS stay, o_orderdate::DATE AS admit,
  o_orderdate::DATE + (o_orderkey % 200)::INTEGER AS discharge FROM orders WHERE o_orderpriority LIKE '1%'"""
PARTS["visits"] = "SELECT o_custkey AS person, o_orderdate::DATE AS visit FROM orders WHERE o_orderpriority LIKE '5%'"


def with_parts(statement: str) -> str:
    """Put every mentioned part, and the parts they mention, in front of a statement."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s*\(?{name}\b", text):
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    if not needed:
        return statement
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in needed) + "\n" + statement


_PAIRS = """SELECT DISTINCT table_name, samplenum FROM (
  SELECT 'demographic' AS table_name, c_nationkey AS samplenum FROM customer
  UNION ALL SELECT 'encounter', (o_orderkey % 23)::INTEGER FROM orders WHERE o_orderkey % 23 <> 5
  UNION ALL SELECT 'provider', s_nationkey FROM supplier UNION ALL SELECT 'facility', n_nationkey FROM nation WHERE n_regionkey <> 3
  UNION ALL SELECT t, n::INTEGER FROM (VALUES ('enrollment'), ('dispensing'), ('diagnosis'), ('procedure'), ('death')) t(t), generate_series(1, 3) g(n))"""
_ENC_COLS = "PatID, EncounterID, ADate, DDate, EncType, FacilityID, Discharge_Disposition, Discharge_Status, DRG, DRG_Type"
_ROUNDTRIP = f"""SELECT {_ENC_COLS}, CASE WHEN EncType = 'IP' THEN '' ELSE Admitting_Source END AS Admitting_Source, samplenum,
  CASE EncounterID % 16 WHEN 0 THEN ' a' WHEN 1 THEN 'b ' WHEN 2 THEN chr(9) || 't' WHEN 3 THEN chr(92) || 'N' WHEN 4 THEN '"q"'
  WHEN 5 THEN 'x' || chr(10) || 'y' WHEN 6 THEN '' WHEN 7 THEN ' ' WHEN 8 THEN 'back' || chr(92) WHEN 9 THEN 'a,b"c' || chr(92) || '"'
  WHEN 10 THEN chr(13) || chr(10) || 'z' WHEN 11 THEN '#' WHEN 12 THEN 'é' || chr(9) WHEN 13 THEN '""' END AS note FROM s_encounter"""


def _spread(unit: str, source: str) -> str:
    return f"""(SELECT samplenum, round(avg(n))::BIGINT AS Mean_{unit}_PatID, round(median(n))::BIGINT AS Median_{unit}_PatID,
  min(n)::BIGINT AS Min_{unit}_PatID, max(n)::BIGINT AS Max_{unit}_PatID
  FROM (SELECT p.samplenum, p.PatID, count(e.samplenum) AS n FROM s_demographic p
    LEFT JOIN {source} e ON e.samplenum = p.samplenum AND e.PatID = p.PatID WHERE p.PatID IS NOT NULL GROUP BY ALL) GROUP BY samplenum)"""


def _stats() -> str:
    age = "date_diff('year', Birth_Date, DATE '2008-01-01') - CASE WHEN strftime(Birth_Date, '%m%d') > '0101' THEN 1 ELSE 0 END"
    months = "((year(Enr_End) - year(Enr_Start)) * 12 + month(Enr_End) - month(Enr_Start) + 1)"
    sex = ", ".join(f"count(*) FILTER (Sex = '{s}') AS Pats_Sex{s}" for s in "AFMU")
    race = ", ".join(f"count(*) FILTER (Race = '{r}') AS Pats_Race{r}" for r in range(6))
    enc = ", ".join(f"count(*) FILTER (EncType = '{t}') AS EncounterIDs_{t}" for t in ("AV", "ED", "IP", "IS", "OA"))
    others = "\n".join(
        f"LEFT JOIN (SELECT samplenum, count(*) AS N_Obs_{t.capitalize()} FROM s_{t} GROUP BY 1) n_{t} USING (samplenum)"
        for t in ("diagnosis", "procedure", "death")
    )
    return f"""SELECT samplenum AS SubSample, * EXCLUDE (samplenum) FROM (
  SELECT samplenum, count(*) AS PatIDs, count(*) FILTER ({age} < 18) AS Pats_Under18, count(*) FILTER ({age} BETWEEN 18 AND 64) AS Pats_18to64,
    count(*) FILTER ({age} >= 65) AS Pats_65plus, {sex}, {race}, count(*) AS N_Obs_Demographic FROM s_demographic WHERE PatID IS NOT NULL GROUP BY 1) d
  JOIN (SELECT samplenum, count(*) AS EncounterIDs, {enc}, count(*) AS N_Obs_Encounter FROM s_encounter GROUP BY 1) e USING (samplenum)
  JOIN {_spread('Encounters', 's_encounter')} se USING (samplenum)
  JOIN (SELECT samplenum, count(*) AS Dispensings, count(*) AS N_Obs_Dispensing FROM s_dispensing GROUP BY 1) x USING (samplenum)
  JOIN {_spread('Dispensings', 's_dispensing')} sd USING (samplenum)
  JOIN (SELECT samplenum, count(*) AS N_Obs_Enrollment,
    coalesce(sum({months}) FILTER (MedCov = 'Y' AND DrugCov = 'Y'), 0)::BIGINT AS EnrollMonths_MedDrug,
    coalesce(sum({months}) FILTER (MedCov = 'Y' AND DrugCov <> 'Y'), 0)::BIGINT AS EnrollMonths_MedOnly,
    coalesce(sum({months}) FILTER (MedCov <> 'Y' AND DrugCov = 'Y'), 0)::BIGINT AS EnrollMonths_DrugOnly FROM s_enrollment GROUP BY 1) r USING (samplenum)
  {others}"""


# Columns and sort orders of the nine tables, stated here once more so that the library is checked against them.
_COLUMNS = {
    "enrollment": """PatID, Enr_Start, Enr_End, MedCov, DrugCov, Chart, PlanType, PayerType""",
    "demographic": """PatID, Birth_Date, Sex, Hispanic, Race, PostalCode, PostalCode_Date, ImputedRace, ImputedHispanic""",
    "dispensing": """PatID, ProviderID, RxDate, Rx, Rx_CodeType, RxSup, RxAmt""",
    "encounter": """PatID, EncounterID, ADate, DDate, EncType, FacilityID, Discharge_Disposition, Discharge_Status, DRG, DRG_Type,
  Admitting_Source""",
    "diagnosis": """PatID, EncounterID, ADate, ProviderID, EncType, DX, Dx_Codetype, OrigDX, PDX, PAdmit""",
    "procedure": """PatID, EncounterID, ADate, ProviderID, EncType, PX, PX_CodeType, OrigPX""",
    "death": """PatID, DeathDt, DtImpute, Source, Confidence""",
    "provider": """ProviderID, Specialty, Specialty_CodeType""",
    "facility": """FacilityID, Facility_Location""",
}
_ORDERS = {
    "enrollment": """PatID NULLS LAST, Enr_Start NULLS LAST, Enr_End NULLS LAST, MedCov NULLS LAST, DrugCov NULLS LAST, Chart NULLS LAST,
  PlanType NULLS LAST, PayerType NULLS LAST""",
    "demographic": """PatID NULLS LAST, Birth_Date NULLS LAST, Sex NULLS LAST, Hispanic NULLS LAST, Race NULLS LAST, PostalCode NULLS LAST,
  PostalCode_Date NULLS LAST, ImputedRace NULLS LAST, ImputedHispanic NULLS LAST""",
    "dispensing": """PatID NULLS LAST, RxDate NULLS LAST, Rx_CodeType NULLS LAST, Rx NULLS LAST, ProviderID NULLS LAST, RxSup NULLS LAST,
  RxAmt NULLS LAST""",
    "encounter": """PatID NULLS LAST, ADate NULLS LAST, EncounterID NULLS LAST, DDate NULLS LAST, EncType NULLS LAST, FacilityID NULLS
  LAST, Discharge_Disposition NULLS LAST, Discharge_Status NULLS LAST, DRG NULLS LAST, DRG_Type NULLS LAST,
  Admitting_Source NULLS LAST""",
    "diagnosis": """PatID NULLS LAST, ADate NULLS LAST, EncounterID NULLS LAST, ProviderID NULLS LAST, EncType NULLS LAST, DX NULLS LAST,
  Dx_Codetype NULLS LAST, OrigDX NULLS LAST, PDX NULLS LAST, PAdmit NULLS LAST""",
    "procedure": """PatID NULLS LAST, ADate NULLS LAST, EncounterID NULLS LAST, ProviderID NULLS LAST, EncType NULLS LAST, PX NULLS LAST,
  PX_CodeType NULLS LAST, OrigPX NULLS LAST""",
    "death": """PatID NULLS LAST, DeathDt NULLS LAST, DtImpute NULLS LAST, Source NULLS LAST, Confidence NULLS LAST""",
    "provider": """ProviderID NULLS LAST, Specialty NULLS LAST, Specialty_CodeType NULLS LAST""",
    "facility": """FacilityID NULLS LAST, Facility_Location NULLS LAST""",
}


def _content(prefix: str, tagged: bool = False, other: dict[str, str] | None = None) -> str:
    """Rows of each table and the sum of a hash of every row's whole content."""
    out = []
    for name, columns in _COLUMNS.items():
        row = ", ".join(f"coalesce({c}::VARCHAR, '~')" for c in columns.replace("\n", " ").split(", "))
        tag, group = ("samplenum, ", " GROUP BY samplenum") if tagged else ("", "")
        source = (other or {}).get(name, f"{prefix}_{name}")
        out.append(
            f"SELECT '{name}' AS table_name, {tag}count(*) AS n_rows, "
            f"coalesce(sum(('0x' || substr(md5(concat_ws('|', {row})), 1, 8))::BIGINT), 0)::BIGINT AS content FROM {source}{group}"
        )
    return " UNION ALL ".join(out)


def _sorted(name: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {_ORDERS[name]}) AS pos FROM t_{name}"


_DECISION = "samplenum, feed, sourcecode, sourcecat, sourcetype, ClinCodeCat, ClinCodeType, cat, type, step"

STATEMENTS: dict[str, str] = {
    "completeness_audit": f"""SELECT t.table_name, n::INTEGER AS samplenum FROM (VALUES ('demographic'), ('encounter'), ('provider'), ('facility'), ('enrollment'), ('dispensing'), ('diagnosis'), ('procedure'), ('death')) t(table_name),
  generate_series((SELECT min(samplenum) FROM ({_PAIRS})), (SELECT max(samplenum) FROM ({_PAIRS}))) g(n)
  WHERE NOT EXISTS (SELECT 1 FROM ({_PAIRS}) f WHERE f.table_name = t.table_name AND f.samplenum = n)""",
    "tagged_scan": "SELECT samplenum, PatID, EncounterID, ADate, DDate, EncType, FacilityID FROM s_encounter",
    "tagged_scan_mixed": """SELECT samplenum, PatID, EncounterID, ADate, CASE WHEN samplenum <> 1 THEN FacilityID END AS FacilityID,
  CASE WHEN samplenum = 2 THEN DRG END AS DRG FROM s_encounter""",
    "tagged_scan_json": "SELECT samplenum, PatID, EncounterID, ADate, EncType, FacilityID FROM s_encounter",
    "append_harmonised": """SELECT s_suppkey AS ID, s_name AS Name, s_nationkey::VARCHAR AS Code, NULL::VARCHAR AS Segment FROM supplier
  UNION ALL SELECT c_custkey, c_name, c_nationkey::VARCHAR, c_mktsegment FROM customer""",
    **{f"sink_roundtrip_{f}": _ROUNDTRIP for f in ("parquet", "csv", "json", "tsv")},
    "export_selection": " UNION ALL ".join(
        f"SELECT *, '{fmt}' AS fmt FROM ({_content('s', True, {n: f'(SELECT * FROM x_{n} WHERE samplenum IN (1, 3))' for n in _COLUMNS})})"
        for fmt in ("parquet", "txt")
    ),
    **{f"crosswalk_{c.lower()}": f"SELECT * FROM cw_{c.lower()}" for c in ("PatID", "EncounterID", "ProviderID", "FacilityID")},
    "rekey_inner": """SELECT a.samplenum, a.PatID AS orig, b.PatID, a.EncounterID, a.ADate FROM s_encounter a
  JOIN cw_patid b ON a.PatID = b.orig_PatID AND a.samplenum = b.samplenum""",
    "rekey_left": """SELECT a.samplenum, a.FacilityID AS orig, b.FacilityID, a.EncounterID, a.ADate FROM s_encounter a
  LEFT JOIN cw_facilityid b ON a.FacilityID = b.orig_FacilityID AND a.samplenum = b.samplenum""",
    "id_collisions": """SELECT PatID, count(DISTINCT samplenum) AS n_samples FROM s_demographic WHERE PatID IS NOT NULL
  GROUP BY PatID HAVING count(DISTINCT samplenum) > 1""",
    **{f"assemble_{n}": f"SELECT * FROM t_{n}" for n in _SOURCED},
    **{f"synthesise_{n}": f"SELECT * FROM t_{n}" for n in ("provider", "facility")},
    **{f"sorted_{n}": _sorted(n) for n in _COLUMNS},
    "get_crosswalk": "SELECT * FROM cw_encounterid",
    "written_order": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_breaks FROM t_{n}" for n in _COLUMNS),
    "order_breaks": """SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_custkey > following) AS n_breaks
  FROM (SELECT o_custkey, lead(o_custkey) OVER (ORDER BY o_orderkey) AS following FROM orders)""",
    "export_all_csv": _content("t"),
    "empty_source": "SELECT PatID, DeathDt, DtImpute, Source, Confidence, samplenum FROM s_death",
    "combine_files": _content("t"),
    "combine_csv": _content("t", other={"dispensing": "k_dispensing"}),
    "combine_json": _content("t", other={"dispensing": "k_dispensing"}),
    "study_window": """SELECT o_orderkey, o_orderdate::DATE AS ADate FROM orders
  WHERE o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
    "junk_codes": f"""SELECT l_orderkey, l_linenumber, raw, replace(raw, 'O', '0') AS code FROM (SELECT l_orderkey, l_linenumber, {_DX} AS raw FROM lineitem)
  WHERE replace(raw, 'O', '0') NOT IN ('0THER', 'XX000', '00000', 'XXXXX', 'T0TAL') AND regexp_matches(replace(raw, 'O', '0'), '[0-9]')""",
    "recode_case": """SELECT samplenum, DESYNPUF_ID, CASE BENE_SEX_IDENT_CD WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE 'U' END AS Sex,
  CASE BENE_RACE_CD WHEN '5' THEN 'Y' WHEN '1' THEN 'N' ELSE 'U' END AS Hispanic,
  CASE BENE_RACE_CD WHEN '1' THEN '5' WHEN '2' THEN '3' ELSE '0' END AS Race, YEAR FROM bene""",
    "coalesce_chain": """SELECT feed, samplenum, CLM_ID, seg AS SEGMENT, prov AS Provider FROM facility_claims, (SELECT 1 AS seg UNION ALL SELECT 2)
  WHERE seg = 1 OR k % 10 = 0
  UNION ALL SELECT feed, samplenum, CLM_ID, NULL, coalesce(CASE WHEN k % 4 <> 0 THEN 'N' || (k % 50)::VARCHAR END,
  CASE WHEN k % 6 <> 0 THEN 'X' || (k % 30)::VARCHAR END, 'UNKNOWN') FROM claims WHERE feed = 'CAR'""",
    "lookup_join_concat": """SELECT samplenum, DESYNPUF_ID, ZIP, YEAR FROM bene LEFT JOIN zips
  ON trim(SP_STATE_CODE) || trim(BENE_COUNTY_CD) = ssacd""",
    "duplicate_keys": """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS counter FROM lineitem) WHERE counter > 1""",
    "group_counts": "SELECT samplenum, PatID, EncounterID, count(*) OVER (PARTITION BY samplenum, PatID) AS counter FROM s_encounter",
    "dedupe_keys": "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL",
    "first_in_group": """SELECT o_custkey, o_orderdate::DATE AS day, o_orderkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "last_in_group": """SELECT o_custkey, o_orderdate::DATE AS day, o_orderkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "max_length_profile": """SELECT 'c_name' AS column_name, coalesce(max(length(rtrim(c_name))), 1) AS max_length FROM customer
  UNION ALL SELECT 'c_mktsegment', coalesce(max(length(rtrim(c_mktsegment))), 1) FROM customer UNION ALL SELECT 'blank', 1""",
    "union_feeds": """SELECT samplenum, DESYNPUF_ID, CLM_ID, CASE WHEN k % 5 = 0 THEN ' ' ELSE 'N' || (k % 50)::VARCHAR END AS AT_PHYSN_NPI,
    NULL::VARCHAR AS TAX_NUM_1, NULL::VARCHAR AS CLM_DRG_CD FROM claims, (SELECT 1 AS seg UNION ALL SELECT 2) WHERE feed = 'OP' AND (seg = 1 OR k % 10 = 0)
  UNION ALL SELECT samplenum, DESYNPUF_ID, CLM_ID, NULL, CASE WHEN k % 6 <> 0 THEN 'X' || (k % 30)::VARCHAR ELSE ' ' END, NULL FROM claims WHERE feed = 'CAR'
  UNION ALL SELECT samplenum, DESYNPUF_ID, CLM_ID, NULL, NULL, lpad((k % 500)::VARCHAR, 3, '0')
    FROM claims, (SELECT 1 AS seg UNION ALL SELECT 2) WHERE feed = 'IP' AND (seg = 1 OR k % 10 = 0)""",
    "union_distinct": "SELECT person, admit AS day FROM stays UNION SELECT person, visit FROM visits",
    "union_tagged": "SELECT YEAR, samplenum, DESYNPUF_ID, BENE_HI_CVRAGE_TOT_MONS, PLAN_CVRG_MOS_NUM FROM bene",
    "episode_gaps": """SELECT person, start_dt, end_dt, n_rows, date_diff('day', lag(end_dt) OVER (PARTITION BY person ORDER BY start_dt, end_dt), start_dt) - 1 AS gap_days
  FROM (SELECT person, start_dt, end_dt, count(*) AS n_rows FROM spells WHERE end_dt >= start_dt GROUP BY ALL)""",
    "episode_spans": _islands("spells", "person", "start_dt", "end_dt", "45"),
    "episode_spans_grace0": _islands("spells", "person", "start_dt", "end_dt", "0"),
    "episode_spans_running_max": _islands(
        "spells", "person", "start_dt", "end_dt", "45",
        "max(end_dt) OVER (PARTITION BY person ORDER BY start_dt, end_dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    ),
    "episode_spans_row_grace": _islands(
        "spells", "person", "start_dt", "end_dt", "grace", "lag(end_dt) OVER (PARTITION BY person ORDER BY start_dt, end_dt, grace)"
    ).replace("ORDER BY start_dt, end_dt ROWS", "ORDER BY start_dt, end_dt, grace ROWS"),
    "timeline_lead": """SELECT person, start_dt, coalesce(lead(start_dt) OVER (PARTITION BY person ORDER BY start_dt) - 1, DATE '2001-12-31') AS PeriodEnd
  FROM (SELECT DISTINCT person, start_dt FROM spells)""",
    "range_join_point": """SELECT s.*, count(v.visit) AS n_visits FROM stays s
  LEFT JOIN visits v ON v.person = s.person AND v.visit BETWEEN s.admit AND s.discharge GROUP BY ALL""",
    "point_join": "SELECT v.person, v.visit, s.stay, s.admit, s.discharge FROM visits v JOIN stays s ON v.person = s.person AND v.visit BETWEEN s.admit AND s.discharge",
    "interval_join": """SELECT s.*, i.start_dt, i.end_dt, i.grace FROM stays s
  JOIN spells i ON i.person = s.person AND s.discharge >= i.start_dt AND i.end_dt >= s.admit""",
    "interval_join_hot": """SELECT s.person, s.stay, count(*) AS n_pairs, min(i.start_dt) AS first, sum(i.grace)::BIGINT AS graces
  FROM (SELECT * REPLACE (CASE WHEN person % 3 = 0 THEN 0 ELSE person END AS person) FROM stays) s
  JOIN (SELECT * REPLACE (CASE WHEN person % 3 = 0 THEN 0 ELSE person END AS person) FROM spells) i
  ON i.person = s.person AND s.discharge >= i.start_dt AND i.end_dt >= s.admit GROUP BY ALL""",
    "interval_overlap": """SELECT s.person, s.stay, s.admit AS p_start, s.discharge AS p_end, count(i.person) AS n_spans FROM stays s
  LEFT JOIN spells i ON i.person = s.person AND s.discharge >= i.start_dt AND i.end_dt >= s.admit GROUP BY ALL""",
    "interval_overlap_odd": """SELECT p.person, p.stay, p.p_start, p.p_end, count(i.person) AS n_spans FROM (
    SELECT person, stay, CASE WHEN stay % 11 = 0 THEN NULL WHEN stay % 7 = 0 THEN discharge ELSE admit END AS p_start,
      CASE WHEN stay % 13 = 0 THEN NULL WHEN stay % 7 = 0 THEN admit ELSE discharge END AS p_end FROM stays) p
  LEFT JOIN (SELECT person, CASE WHEN grace % 11 = 0 THEN NULL WHEN grace % 5 = 0 THEN end_dt ELSE start_dt END AS s_start,
      CASE WHEN grace % 13 = 0 THEN NULL WHEN grace % 5 = 0 THEN start_dt ELSE end_dt END AS s_end FROM spells) i
  ON i.person = p.person AND p.p_start <= p.p_end AND i.s_start <= i.s_end AND p.p_end >= i.s_start AND i.s_end >= p.p_start GROUP BY ALL""",
    "coverage_timeline": _timeline(
        "kinded", "person", "start_dt", "end_dt", "2001-06-30", {"a": "CovA", "b": "CovB"}
    ),
    "coverage_summary": "SELECT * FROM summary",
    "coverage_intervals": "SELECT * FROM cov",
    "enrollment_build": "SELECT * FROM enr",
    "first_enrollment_date": "SELECT * FROM firsts",
    "enrolled_only": """SELECT (c_custkey % 3 + 1)::INTEGER AS samplenum, 'P' || lpad((c_custkey // 3)::VARCHAR, 9, '0') AS PatID FROM customer
  WHERE ((c_custkey % 3 + 1)::INTEGER, 'P' || lpad((c_custkey // 3)::VARCHAR, 9, '0')) IN (SELECT (samplenum, PatID) FROM enr)""",
    "demographic_build": "SELECT * FROM demo",
    "death_build": "SELECT * FROM deaths",
    "dispensing_build": "SELECT * FROM disp",
    "unpivot_codes": "SELECT * FROM long",
    "px_code_types": f"""SELECT l_orderkey, l_linenumber, raw, CASE WHEN regexp_matches(replace(raw, 'O', '0')[1:1], '[A-Za-z]') THEN 'HC'
  WHEN length(raw) < 5 THEN '09' WHEN raw[5:5] = 'F' THEN 'C2' WHEN raw[5:5] = 'T' THEN 'C3' ELSE 'C4' END AS codetype
  FROM (SELECT l_orderkey, l_linenumber, {_PX} AS raw FROM lineitem)""",
    "claims_per_code": "SELECT * FROM counted",
    "codetype_match": "SELECT * FROM matched",
    "codetype_steps": "SELECT * FROM decided",
    "anti_leftovers": f"SELECT {_DECISION}, cat AS route FROM unmatched",
    "tempdx": "SELECT * FROM dx",
    "temppx": "SELECT * FROM px",
    "primary_dx": "SELECT samplenum, PatID, EncounterID, DX, Dx_Codetype, PDX FROM dx WHERE feed = 'IP'",
    "claim_flags": "SELECT * FROM flags",
    "encounter_op": "SELECT * FROM enc_op",
    "encounter_car": "SELECT * FROM enc_car",
    "encounter_ip": "SELECT * FROM enc_ip",
    "detail_header_join": """SELECT DISTINCT a.*, h.ADate, h.Provider, h.EncType FROM dx a
  JOIN headers h ON h.samplenum = a.samplenum AND h.feed = a.feed AND h.EncounterID = a.EncounterID""",
    **{f"finalise_{n}": f"SELECT * FROM f_{n}" for n in _COLUMNS},
    "translate_e2e": _content("f", True),
    "translate_then_combine": """SELECT 'encounter' AS table_name, p.id AS PatID, e.id AS EncounterID, ADate, DDate, EncType, f.id AS FacilityID,
  Discharge_Disposition, Discharge_Status, DRG, DRG_Type, Admitting_Source, NULL::BIGINT AS ProviderID, NULL::VARCHAR AS DX,
  NULL::VARCHAR AS Dx_Codetype, NULL::VARCHAR AS OrigDX, NULL::VARCHAR AS PDX, NULL::VARCHAR AS PAdmit
  FROM f_encounter a JOIN c_pat p ON p.samplenum = a.samplenum AND p.orig = a.PatID
  LEFT JOIN c_enc e ON e.samplenum = a.samplenum AND e.orig = a.EncounterID
  LEFT JOIN c_fac f ON f.samplenum = a.samplenum AND f.orig = a.FacilityID
  UNION ALL SELECT 'diagnosis', p.id, e.id, ADate, NULL, EncType, NULL, NULL, NULL, NULL, NULL, NULL, v.id, DX, Dx_Codetype, OrigDX, PDX, PAdmit
  FROM f_diagnosis a JOIN c_pat p ON p.samplenum = a.samplenum AND p.orig = a.PatID
  LEFT JOIN c_enc e ON e.samplenum = a.samplenum AND e.orig = a.EncounterID
  LEFT JOIN c_prov v ON v.samplenum = a.samplenum AND v.orig = a.ProviderID""",
    "encounters_per_patient": """SELECT p.samplenum, p.PatID, count(e.samplenum) AS n_encounters FROM s_demographic p
  LEFT JOIN s_encounter e ON e.samplenum = p.samplenum AND e.PatID = p.PatID WHERE p.PatID IS NOT NULL GROUP BY ALL""",
    "descriptive_stats": _stats(),
    "export_stats": _stats(),
}
_GAP = {n: "(SELECT * FROM f_dispensing WHERE samplenum <> 2)" if n == "dispensing" else f"f_{n}" for n in _COLUMNS}
STATEMENTS["translate_gap_then_combine"] = " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, count(*) AS n FROM {_GAP[n]} a JOIN c_pat p ON p.samplenum = a.samplenum AND p.orig = a.PatID" for n in _COLUMNS if n not in ("provider", "facility")]
    + [f"SELECT '{n}', count(*) FROM {c}" for n, c in (("provider", "c_prov"), ("facility", "c_fac"))]
    + [f"SELECT 'empty {n}', m FROM range(1, 4) r(m) WHERE m NOT IN (SELECT samplenum FROM {_GAP[n]})" for n in _COLUMNS]
)
PARTS["kinded"] = "SELECT person, start_dt, end_dt, CASE WHEN grace % 2 = 0 THEN 'a' ELSE 'b' END AS kind FROM spells"


def oracle_sql() -> dict[str, str]:
    return {name: with_parts(text) for name, text in STATEMENTS.items()}
