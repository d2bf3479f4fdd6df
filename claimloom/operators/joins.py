"""Joins whose cost does not depend on how rows are spread over keys.

Every join in the library looks rows up in a table that has few rows per key
(a crosswalk, a code list, claim headers).  ``skew_join`` decides how to run it:

* the looked-up side is measured if it is read from files, unless the caller
  knows its size or knows it to be ``LARGE``; when it is small it is broadcast,
  and the large side is not shuffled at all.  A side that would have to be
  computed twice is left to Spark's run-time choice;
* otherwise both sides are shuffled on the key.  Keys that hold a large share
  of the left rows, found on a sample, and missing keys, are spread over
  ``salts`` partitions; the right rows of those hot keys are repeated once per
  salt.  The result is the same whichever keys are called hot, so the sample
  may come from a cheaper table with the same keys (``keys_from``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_BYTES = 32 * 1024 * 1024
SALTS = 64
HOT_SHARE = 1 / 256
SAMPLE = 0.01
MIN_SAMPLED = 64
_SKETCH_ITEMS = 8192
LARGE = 1 << 62

_SALT = "_salt"


def row_bytes(df: DataFrame) -> Column:
    """Size of a row's values: text lengths and 16 bytes per value."""
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in text]
    return reduce(lambda a, b: a + b, lengths, F.lit(16 * len(df.columns)).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """Exact size of a table's values by ``row_bytes``."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


@dataclass(frozen=True)
class HotKeys:
    """Hashes of keys with many rows, and whether rows without a key are many."""

    hashes: list[int]
    missing: bool


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE, sample: float = SAMPLE) -> HotKeys:
    """Keys that hold more than ``share`` of a sample of the rows.

    A frequent-items sketch of fixed size is merged from all tasks, so neither
    the keys nor their counts are shuffled; at most ``1 / share`` keys come back.
    """
    keys = df.select(F.when(~_no_key(on), F.xxhash64(*on)).alias("h"))
    if sample < 1:
        keys = keys.sample(sample, seed=17)
    found = keys.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("h").alias("known"),
        F.expr(f"approx_top_k(h, {int(1 / share)}, {_SKETCH_ITEMS}) FILTER (WHERE h IS NOT NULL)").alias("top"),
    ).first()
    least = max(share * found["n"], MIN_SAMPLED)
    hashes = [t["item"] for t in found["top"] or [] if t["count"] > least]
    return HotKeys(hashes, found["n"] - found["known"] > least)


_PLAN_OPTIONS = {"small_bytes", "salts", "sample"}
_CHEAP_NODES = {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "Range", "Union"}


def check_options(options) -> None:
    """Plans hand these settings to every join; a size or a key table belongs to one join only."""
    wrong = set(options) - _PLAN_OPTIONS
    if wrong:
        raise ValueError(f"not settings for all joins: {', '.join(sorted(wrong))}")


def is_cheap(df: DataFrame) -> bool:
    """Whether a frame only reads, so that measuring or sampling it repeats no work."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {m[1] for m in (re.match(r"[\s:+|-]*([A-Za-z]+)", line) for line in plan.splitlines()) if m}
    return nodes <= _CHEAP_NODES


def _no_key(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def _spread(df: DataFrame, salts: int) -> Column:
    # Deterministic for a row wherever it is recomputed; equal rows that sit in
    # different input partitions get different salts.
    return F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts)).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    right_bytes: int | None = None,
    small_bytes: int | None = None,
    salts: int | None = None,
    sample: float | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on same-named columns; ``how`` is inner, left, left_semi or left_anti.

    ``right_bytes`` is an upper bound of the right side's size.
    """
    on = list(on)
    small_bytes = SMALL_BYTES if small_bytes is None else small_bytes
    salts = SALTS if salts is None else salts
    sample = SAMPLE if sample is None else sample

    # A side that would have to be computed is not measured; Spark sees its size when it has run.
    size = right_bytes if right_bytes is not None else measured_bytes(right) if is_cheap(right) else LARGE
    if size <= small_bytes:
        return left.join(F.broadcast(right), on, how)

    # One type on both sides, so that both hash a key alike.
    for c in on:
        if left.schema[c].dataType != right.schema[c].dataType:
            right = right.withColumn(c, F.col(c).cast(left.schema[c].dataType))
    if keys_from is None and not is_cheap(left):
        return left.join(right, on, how)  # split at run time where partitions turn out large
    typed = left if keys_from is None else keys_from.select(*[F.col(c).cast(left.schema[c].dataType) for c in on])
    hot = hot_keys(typed, on, sample=sample)
    spread_missing = hot.missing and how in ("left", "left_anti")
    if not hot.hashes and not spread_missing:
        return left.join(right, on, how)

    is_hot = F.xxhash64(*on).isin(hot.hashes) if hot.hashes else F.lit(False)
    many = (_no_key(on) | is_hot) if spread_missing else (~_no_key(on) & is_hot)
    salted = left.withColumn(_SALT, F.when(many, _spread(left, salts)).otherwise(0))
    if hot.hashes:
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        repeated = right.withColumn(_SALT, F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    else:
        # Always 0, but not a constant that the optimizer would take out of the join key.
        repeated = right.withColumn(_SALT, F.pmod(F.xxhash64(*on), F.lit(1)).cast("int"))
    new = [c for c in right.columns if c not in on] if how in ("inner", "left") else []
    return salted.join(repeated, [*on, _SALT], how).select(*left.columns, *new)


def rekey(df: DataFrame, crosswalk: DataFrame, id_column: str, how: str = "inner", **options) -> DataFrame:
    """Replace an original id by its new id, matching on (original id, samplenum).

    ``inner`` drops rows without a match, ``left`` gives them a null id.  The
    column keeps its place.
    """
    new = "_new_id"
    lookup = crosswalk.select(
        F.col(f"orig_{id_column}").alias(id_column), "samplenum", F.col(id_column).alias(new)
    )
    joined = skew_join(df, lookup, [id_column, "samplenum"], how, **options)
    return joined.select(*[F.col(new).alias(c) if c == id_column else F.col(c) for c in df.columns])


def match_lookup(df: DataFrame, lookup: DataFrame, key: Column, lookup_key: str, **options) -> DataFrame:
    """Left join to a lookup on a computed key; the key itself is not kept."""
    right = lookup.withColumnRenamed(lookup_key, "_key")
    joined = skew_join(df.withColumn("_key", key), right, ["_key"], "left", **options)
    return joined.drop("_key")


def _by_membership(df: DataFrame, members: DataFrame, keys: Sequence[str], how: str, options: dict) -> DataFrame:
    # Measured before the duplicates go, which needs no shuffle and bounds the size.
    if options.get("right_bytes") is None:
        options["right_bytes"] = measured_bytes(members) if is_cheap(members) else LARGE
    return skew_join(df, members.distinct(), keys, how, **options)


def only_in(df: DataFrame, members: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return _by_membership(df, members.select(*keys), keys, "left_semi", options)


def not_in(df: DataFrame, members: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Rows whose key does not occur in ``members``."""
    return _by_membership(df, members.select(*keys), keys, "left_anti", options)
