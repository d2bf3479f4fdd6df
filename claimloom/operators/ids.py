"""Dense, ordered surrogate numbers without a single-partition window.

Rows are range-partitioned and sorted by the wanted order and written once,
each with its range number and its row number in that range.  The row counts
of the ranges, one number per partition, then give the start of every range.
The written table fixes the ranges, so a lost executor cannot change an id,
and a group that holds a third of all rows is cut like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import rekey, row_bytes
from claimloom.workspace import Workspace

_IN_PARTITION = (1 << 33) - 1


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, ws: Workspace, within: str | None = None
) -> DataFrame:
    """Add ``name`` = 1..N in the given order, nulls last.

    With ``within``, which must be the first order column, numbers restart at
    1 for each of its values.  Only rows equal in every order column may swap.
    """
    return _number(df, order, name, ws, within)[0]


def _number(df, order, name, ws, within) -> tuple[DataFrame, int, int]:
    """The numbered rows, their measured size and their number."""
    if within is not None and order[0] != within:
        raise ValueError(f"the first order column must be {within}")
    keys = [F.col(c).asc_nulls_last() for c in order]
    placed = (
        # The input partition comes last, so that a large group of equal rows can be cut too.
        df.withColumn("_src", F.spark_partition_id())
        .repartitionByRange(*keys, "_src")
        .drop("_src")
        .sortWithinPartitions(*keys)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
    )
    kept = ws.keep(placed, f"numbered-{name}")
    groups = ["_range"] if within is None else ["_range", within]
    counts = kept.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(kept)).alias("bytes")).collect()

    per_range: dict[int, int] = {}
    per_group: dict = {}
    for r in counts:
        per_range[r["_range"]] = per_range.get(r["_range"], 0) + r["n"]
        if within is not None:
            per_group[r[within]] = per_group.get(r[within], 0) + r["n"]
    sizes = [per_range.get(i, 0) for i in range(max(per_range, default=0) + 1)]
    starts = [0, *accumulate(sizes)][:-1]
    # One literal array; the optimizer folds the split and the cast.
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), F.col("_range"))
    number = start + F.col("_row") + 1
    size, rows = sum(r["bytes"] for r in counts), sum(sizes)

    if within is None or not per_group:
        return kept.select(*df.columns, number.alias(name)), size, rows
    ranked = sorted(per_group, key=lambda v: (v is None, v))
    before = dict(zip(ranked, [0, *accumulate(per_group[v] for v in ranked)]))
    # One row per subsample; their number is that of the input file sets.
    offsets = ws.spark.createDataFrame(
        [(v, before[v]) for v in ranked if v is not None],
        f"{within} {df.schema[within].dataType.simpleString()}, _before long",
    )
    joined = kept.join(F.broadcast(offsets), within, "left")
    return joined.select(*df.columns, (number - F.col("_before")).alias(name)), size, rows


@dataclass
class Crosswalk:
    """New ids of one id column: ``(orig_<id>, samplenum, <id>)``, their measured size and number."""

    id_column: str
    frame: DataFrame
    size: int
    rows: int

    def apply(self, df: DataFrame, how: str, column: str | None = None, **options) -> DataFrame:
        """Re-key ``column`` (default: the crosswalk's own id column) of ``df``."""
        if column is not None and column != self.id_column:
            df = df.withColumnRenamed(column, self.id_column)
        options.setdefault("right_bytes", self.size)
        return rekey(df, self.frame, self.id_column, how, **options)


def build_crosswalk(
    df: DataFrame, id_column: str, ws: Workspace, restart: bool = False, orig: str | None = None
) -> Crosswalk:
    """Number the distinct, non-missing (samplenum, original id) pairs.

    ``restart`` restarts the ids at 1 in each subsample; ``orig`` names the
    source column when it differs from ``id_column``.
    """
    source = orig or id_column
    pairs = (
        df.where(F.col(source).isNotNull())
        .select(F.col(source).alias(f"orig_{id_column}"), "samplenum")
        .distinct()
    )
    order = ["samplenum", f"orig_{id_column}"]
    return Crosswalk(id_column, *_number(pairs, order, id_column, ws, "samplenum" if restart else None))


def id_collisions(df: DataFrame, id_column: str) -> DataFrame:
    """Original ids that occur in more than one subsample."""
    return (
        df.where(F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(F.count_distinct("samplenum").alias("n_samples"))
        .where(F.col("n_samples") > 1)
    )
