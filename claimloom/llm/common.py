"""Helpers that several operators of this package share."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimloom.workspace import Workspace

_IN_PARTITION = (1 << 33) - 1
_open: dict[str, Workspace] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_workspace(spark: SparkSession, name: str) -> Workspace:
    """Workspace of the current run of ``name``; what its last run wrote is deleted first."""
    release(name)
    _open[name] = Workspace(spark)
    return _open[name]


def release(name: str) -> None:
    """Delete what the last run of ``name`` wrote, once its result is consumed."""
    old = _open.pop(name, None)
    if old is not None:
        with contextlib.suppress(Exception):  # its session may have ended
            old.close()


def prefix_sums(
    df: DataFrame, within: str, order: Sequence[str], sums: Sequence[str], ws: Workspace, suffix: str = "_before"
) -> DataFrame:
    """Add ``<sum>_before``: the total of each column over the rows that come earlier in the row's group.

    Rows are range-partitioned by group and order and written once with their
    range and place, so a lost executor cannot move a cut.  A large group covers
    many ranges.  Inside a range the sums run in a window; the totals of the
    ranges, one row per range and group, give where each range begins.
    Nulls come last; rows equal in every order column may swap.  Columns of
    ``df`` keep their values, unless their names begin with ``_ps_``.
    """
    keys = [F.col(within).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order]]
    placed = (
        # The input partition comes last, so that a large set of equal rows can be cut too.
        df.withColumn("_ps_src", F.spark_partition_id())
        .repartitionByRange(*keys, "_ps_src")
        .drop("_ps_src")
        .sortWithinPartitions(*keys)
        .withColumn("_ps_range", F.spark_partition_id())
        .withColumn("_ps_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
    )
    kept = ws.keep(placed, "ranges")
    inside, earlier = _before(["_ps_range", within], "_ps_row"), _before(["_ps_g"], "_ps_r")
    totals = kept.groupBy(F.col(within).alias("_ps_g"), F.col("_ps_range").alias("_ps_r")).agg(
        *[F.sum(c).alias(f"_t_{c}") for c in sums]
    )
    begins = totals.select(
        "_ps_g", "_ps_r", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums]
    )
    running = kept.select(*df.columns, "_ps_range", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_i_{c}") for c in sums])
    same = (F.col("_ps_range") == F.col("_ps_r")) & F.col(within).eqNullSafe(F.col("_ps_g"))
    return running.join(begins, same).select(
        *df.columns, *[(F.col(f"_i_{c}") + F.col(f"_b_{c}")).alias(f"{c}{suffix}") for c in sums]
    )


def _before(group: Sequence[str], order: str):
    return W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
