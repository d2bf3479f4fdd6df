"""Row filters, keys, grouped picks and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.joins import LARGE, skew_join
from claimloom.schema import STUDY_END, STUDY_START, TableSpec


def study_window(df: DataFrame, column: str, lo: str = STUDY_START, hi: str = STUDY_END) -> DataFrame:
    """Rows dated inside the study, both ends included."""
    return df.where(F.col(column).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def drop_null_ids(df: DataFrame, id_column: str) -> DataFrame:
    return df.where(F.col(id_column).isNotNull())


def first_segment(df: DataFrame, column: str = "SEGMENT") -> DataFrame:
    return df.where(F.col(column) == 1)


def valid_intervals(df: DataFrame, start: str, end: str, strict: bool = False) -> DataFrame:
    """Keep ``end >= start``, or ``end > start`` when strict."""
    return df.where(F.col(end) > F.col(start) if strict else F.col(end) >= F.col(start))


def with_constants(df: DataFrame, values: Mapping[str, str | Column | None]) -> DataFrame:
    """Add constant text columns; ``None`` gives a null string."""
    new = {c: v if isinstance(v, Column) else F.lit(v).cast("string") for c, v in values.items()}
    return df.withColumns(new)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def date_if_present(flag: Column | str, date: Column | str) -> Column:
    """The date where the flag column has a value, else null."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag.isNotNull(), F.col(date) if isinstance(date, str) else date)


def keep_prefixed(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    """Names of the columns that start with one of the prefixes, ignoring case."""
    low = tuple(p.lower() for p in prefixes)
    return [c for c in df.columns if c.lower().startswith(low)]


def contract_columns(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The declared columns in the declared order; absent ones as typed nulls."""
    types = {f.name: f.dataType for f in spec.struct(samplenum=False)}
    have = {c.lower(): c for c in df.columns}
    return [
        F.col(have[c.lower()]).alias(c) if c.lower() in have else F.lit(None).cast(types[c]).alias(c)
        for c in spec.columns
    ]


def contract_select_tagged(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of the contract, and samplenum."""
    return df.select(*contract_columns(df, spec), "samplenum")


def contract_select(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the columns of the contract."""
    return df.select(*contract_columns(df, spec))


def check_sort_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Refuse to sort when keys are missing, and name all of them."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"sort keys not in table: {', '.join(missing)}")


def sort_contract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Order rows by the table's sort keys, nulls last.

    The remaining columns break ties, so the range exchange can also cut a
    patient who holds a large share of the rows; the input partition at the
    very end cuts groups of identical rows.
    """
    check_sort_keys(df, spec.sort_keys)
    order = [F.col(c).asc_nulls_last() for c in spec.order if c in df.columns]
    return df.withColumn("_part", F.spark_partition_id()).orderBy(*order, "_part").drop("_part")


def dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or for each key the row that is smallest in the other columns."""
    if keys is None:
        return df.distinct()
    return first_in_group(df, keys, [c for c in df.columns if c not in keys])


def first_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group, nulls first; a grouped minimum, so it combines before the shuffle."""
    rest = [c for c in df.columns if c not in by]
    row = F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_row")
    picked = df.groupBy(*by).agg(row)
    return picked.select(*[F.col(c) if c in by else F.col(f"_row.{c}").alias(c) for c in df.columns])


def last_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each group in the given order."""
    rest = [c for c in df.columns if c not in by]
    row = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_row")
    picked = df.groupBy(*by).agg(row)
    return picked.select(*[F.col(c) if c in by else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _with_counts(df: DataFrame, keys: Sequence[str], name: str, at_least: int, how: str, options) -> DataFrame:
    # A struct compares equal to another even where a key is null, so missing
    # keys form a group as well.
    key = F.struct(*keys)
    counts = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) >= at_least)
    return skew_join(df.withColumn("_key", key), counts, ["_key"], how, **options).drop("_key")


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "counter", **options) -> DataFrame:
    """All rows whose key occurs more than once, with the number of occurrences."""
    return _with_counts(df, keys, name, 2, "inner", options)


def with_group_count(df: DataFrame, keys: Sequence[str], name: str = "counter", **options) -> DataFrame:
    """Every row with the number of rows of its key."""
    # Counts exist for every key, so they are not measured first.
    return _with_counts(df, keys, name, 1, "left", {"right_bytes": LARGE, **options})


def sum_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Grouped sums; ``measures`` maps input column to output name."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for c, out in measures.items()])


def min_max_by(df: DataFrame, keys: Sequence[str], **picks: tuple[str, str]) -> DataFrame:
    """Grouped minima and maxima: ``name=("min" | "max", column)``."""
    how = {"min": F.min, "max": F.max}
    return df.groupBy(*keys).agg(*[how[f](c).alias(out) for out, (f, c) in picks.items()])


def pivot_sum(
    df: DataFrame, keys: Sequence[str], tag: str, tags: Sequence[int], measures: Mapping[str, str], extra=()
) -> DataFrame:
    """Sum each measure per tag value in one pass: output ``<name>_<tag>``.

    A row of another tag counts as zero when its measure is known, so a sum is
    null only if the measure is missing in every row of the group.
    """
    sums = [
        F.sum(F.when(F.col(tag) == t, F.col(c)).when(F.col(c).isNotNull(), F.lit(0))).alias(f"{out}_{t}")
        for c, out in measures.items()
        for t in tags
    ]
    return df.groupBy(*keys).agg(*extra, *sums)


def row_count(df: DataFrame) -> int:
    return df.count()


def max_length_profile(df: DataFrame) -> DataFrame:
    """Longest value, without trailing blanks, of each text column; 1 where all are missing."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df.sparkSession.createDataFrame([], "column_name string, max_length long")
    longest = df.agg(*[F.coalesce(F.max(F.length(F.rtrim(c))), F.lit(1)).cast("long").alias(c) for c in text])
    return longest.unpivot([], text, "column_name", "max_length")


def union_feeds(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; a column absent from one feed is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def union_tagged(frames: Mapping, column: str) -> DataFrame:
    """Concatenate frames, each tagged with its key in ``column``."""
    return union_feeds(*[df.withColumn(column, F.lit(tag)) for tag, df in frames.items()])
