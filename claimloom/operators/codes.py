"""Claim codes: wide to long, and which category and type each code has.

The decision is made once per distinct code, after claim lines have been
reduced to code counts; the lines then look their code up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.scalars import is_real_code, joined_key, px_code_type, zero_for_o
from claimloom.operators.joins import not_in, skew_join

DX, PX = "DX", "PX"

# Fixed values: (column prefix, number of columns, category) of each claims feed.
CODE_GROUPS = {
    "OP": (("ICD9_DGNS_CD", 10, DX), ("ICD9_PRCDR_CD", 6, PX), ("HCPCS_CD", 45, PX)),
    "CAR": (("ICD9_DGNS_CD", 10, DX), ("LINE_ICD9_DGNS_CD", 13, DX), ("HCPCS_CD", 45, PX)),
    "IP": (("ICD9_DGNS_CD", 10, DX), ("ICD9_PRCDR_CD", 6, PX), ("HCPCS_CD", 45, PX)),
}


def unpivot_codes(claims: DataFrame, keys: Sequence[str], groups: Sequence[tuple[str, int, str]]) -> DataFrame:
    """One row per non-blank code column of a claim, junk codes left out.

    Columns of a group that the input lacks are skipped.
    """
    have = {c.lower(): c for c in claims.columns}
    slots = [
        (prefix, number, category, have[f"{prefix}_{number}".lower()])
        for prefix, count, category in groups
        for number in range(1, count + 1)
        if f"{prefix}_{number}".lower() in have
    ]
    if not slots:
        raise ValueError("no code columns found")

    def of_slot(i: int) -> Column:
        return F.get(F.lit([s[i] for s in slots]), F.col("_slot"))

    long = claims.select(*keys, F.posexplode(F.array(*[F.col(s[3]) for s in slots])).alias("_slot", "_raw"))
    coded = long.select(
        *keys,
        F.rtrim(zero_for_o("_raw")).alias("sourcecode"),
        of_slot(2).alias("sourcecat"),
        F.when(of_slot(2) == DX, "09").otherwise(px_code_type("_raw")).alias("sourcetype"),
        F.lower(of_slot(0)).alias("sourcevar"),
        of_slot(1).cast("int").alias("sourcevarnum"),
    )
    # A real code has a digit, so blanks are left out as well.
    return coded.where(is_real_code("sourcecode"))


def claims_per_code(long: DataFrame, within: Sequence[str], claim: str = "CLM_ID") -> DataFrame:
    """Distinct claims per code, source category and source type."""
    return long.groupBy(*within, "sourcecode", "sourcecat", "sourcetype").agg(
        F.count_distinct(claim).alias("clm_count")
    )


def match_codes(counted: DataFrame, master: DataFrame, within: Sequence[str], **options) -> DataFrame:
    """Look codes up in the master list by code alone and classify the match per code.

    ``counted`` has one row per distinct code and source kind.  Adds every
    listed (ClinCodeCat, ClinCodeType), the numbers of distinct source and
    listed kinds of the code, and the match type ``{1|MANY}:{0|1|MANY}``.
    """
    listed = master.select(F.col("ClinCode").alias("sourcecode"), "ClinCodeCat", "ClinCodeType").distinct()
    rows = skew_join(counted, listed, ["sourcecode"], "left", **options)
    # Few rows per code: its source kinds times its listed kinds.
    code = Window.partitionBy(*within, "sourcecode")

    def kinds(a: str, b: str) -> Column:
        return F.size(F.collect_set(joined_key(a, b)).over(code)).cast("long")

    def word(n: str) -> Column:
        return F.when(F.col(n) == 0, "0").when(F.col(n) == 1, "1").otherwise("MANY")

    return (
        rows.withColumn("real_code_count", kinds("ClinCodeCat", "ClinCodeType"))
        .withColumn("source_code_count", kinds("sourcecat", "sourcetype"))
        .withColumn("match_type", F.concat_ws(":", word("source_code_count"), word("real_code_count")))
    )


def decide_codes(matched: DataFrame, within: Sequence[str]) -> DataFrame:
    """Category, type, step and destination (DX, PX or LEFT) of each matched row.

    A leftover row is used (DX or PX by its listed category) only if no row of
    its code went to DX or PX.
    """
    none, one = F.col("real_code_count") == 0, F.col("real_code_count") == 1
    many_sources = F.col("source_code_count") > 1
    same_cat = F.coalesce(F.col("sourcecat") == F.col("ClinCodeCat"), F.lit(False))
    same_kind = same_cat & F.coalesce(F.col("sourcetype") == F.col("ClinCodeType"), F.lit(False))

    def by_sources(single: str, many: str) -> Column:
        return F.when(many_sources, many).otherwise(single)

    step = (
        F.when(none, by_sources("1", "2"))
        .when(one, by_sources("3", "4"))
        .when(same_kind, by_sources("5.1", "6.1"))
        .when(same_cat, by_sources("5.2", "6.2"))
        .otherwise(by_sources("5.3", "6.3"))
    )
    leftover = F.col("step").isin("5.3", "6.3")
    placed = ~leftover & F.col("cat").isin(DX, PX)
    code = Window.partitionBy(*within, "sourcecode")
    return (
        matched.withColumn("step", step)
        .withColumn("cat", F.when(none, F.col("sourcecat")).otherwise(F.col("ClinCodeCat")))
        .withColumn("type", F.when(none, "OT").otherwise(F.col("ClinCodeType")))
        .withColumn("_found", F.max(placed).over(code))
        .withColumn(
            "route",
            F.when(placed, F.col("cat")).when(leftover & ~F.col("_found") & F.col("cat").isin(DX, PX), F.col("cat")).otherwise("LEFT"),
        )
        .drop("_found")
    )


def unmatched_codes(decided: DataFrame, within: Sequence[str], **options) -> DataFrame:
    """Leftover rows whose code was placed nowhere else."""
    leftover = decided.where(F.col("step").isin("5.3", "6.3"))
    placed = decided.where(~F.col("step").isin("5.3", "6.3") & F.col("cat").isin(DX, PX))
    return not_in(leftover, placed, [*within, "sourcecode"], **options)


def listed_flags(decided: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """Mark decided procedure types that are on a code list; ``lists`` maps a flag column to a list."""
    tagged = None
    for flag, frame in lists.items():
        one = frame.select(F.col("ClinCode").alias("sourcecode"), F.col("ClinCodeType").alias("type"), F.lit(flag).alias("_flag"))
        tagged = one if tagged is None else tagged.unionByName(one)
    flags = tagged.groupBy("sourcecode", "type").agg(*[F.max(F.col("_flag") == flag).alias(flag) for flag in lists])
    joined = skew_join(decided, flags, ["sourcecode", "type"], "left")
    return joined.withColumns({flag: F.coalesce(F.col(flag), F.lit(False)) & (F.col("route") == PX) for flag in lists})


def typed_lines(long: DataFrame, decided: DataFrame, within: Sequence[str], flags: Sequence[str] = (), **options) -> DataFrame:
    """Claim lines with their destination ``route`` and decided type, in columns ``code`` and ``codetype``.

    A line appears once per destination and type its code was given.
    ``first_dx`` marks the first diagnosis column; ``flags`` come from the decisions.
    """
    on = [*within, "sourcecode", "sourcecat", "sourcetype"]
    chosen = decided.where(F.col("route").isin(DX, PX)).select(*on, "route", F.col("type").alias("codetype"), *flags).distinct()
    lines = skew_join(long, chosen, on, "inner", **options)
    return (
        lines.withColumn("first_dx", (F.col("sourcevarnum") == 1) & (F.col("sourcecat") == DX))
        .withColumnRenamed("sourcecode", "code")
        .drop("sourcecat", "sourcetype", "sourcevar", "sourcevarnum")
    )


def type_codes(long: DataFrame, decided: DataFrame, route: str, within: Sequence[str], **options) -> DataFrame:
    """Claim lines of one destination, see ``typed_lines``."""
    return typed_lines(long, decided.where(F.col("route") == route), within, **options).drop("route")


def distinct_codes(lines: DataFrame) -> DataFrame:
    """One row per claim, code and type: ``first_dx`` if any of its lines is."""
    return lines.groupBy(*[c for c in lines.columns if c != "first_dx"]).agg(F.max("first_dx").alias("first_dx"))


def claim_flags(lines: DataFrame, flags: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per claim, whether any procedure is on each code list."""
    return lines.groupBy(*keys).agg(*[F.max(f).alias(f) for f in flags])
