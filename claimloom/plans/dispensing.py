"""Drug events to dispensings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.scalars import digits_only
from claimloom.operators.rows import sum_by


def build_dispensing(pde: DataFrame) -> DataFrame:
    """Supply and amount per person, date and drug; drug codes with letters are dropped."""
    events = pde.where(digits_only("PROD_SRVC_ID")).select(
        "samplenum",
        F.col("DESYNPUF_ID").alias("PatID"),
        F.col("SRVC_DT").alias("RxDate"),
        F.col("PROD_SRVC_ID").alias("NDC"),
        "DAYS_SUPLY_NUM",
        "QTY_DSPNSD_NUM",
    )
    return sum_by(
        events, ["samplenum", "PatID", "RxDate", "NDC"], {"DAYS_SUPLY_NUM": "RxSup", "QTY_DSPNSD_NUM": "RxAmt"}
    )
