"""Proof that a written table lies in its order, without sorting or shuffling it.

Each task passes once over the rows of its file ranges, in the order in which
they lie there, and compares neighbours.  One line per range comes back: its
first and last key and the places out of order.  Only these lines, one per
128 MB or so, are then compared from range to range.  Order between neighbours
cannot be told by Spark's own operators unless rows are shuffled, so the pass
is an Arrow one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources.readers import read_format

_PLACE = ("_part", "_piece", "_from")


def _places() -> list[Column]:
    # Part files are numbered, several of one task by a second number; names
    # of more than 100,000 parts do not sort as text.
    def number(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("long"), F.lit(0).cast("long"))

    start = F.col("_metadata.file_block_start").cast("long")
    return [c.alias(name) for c, name in zip((number(r"^part-(\d+)"), number(r"-c(\d+)\."), start), _PLACE)]


def _neighbours(table: pa.Table, keys: Sequence[str]) -> pa.ChunkedArray:
    """Whether each row comes after the next one by the keys, nulls last."""
    after, same = pa.scalar(False), pa.scalar(True)
    for k in keys:
        column = table.column(k).combine_chunks()
        a, b = column.slice(0, len(column) - 1), column.slice(1)
        a_null, b_null = pc.is_null(a), pc.is_null(b)
        greater = pc.or_(pc.and_(a_null, pc.invert(b_null)), pc.fill_null(pc.greater(a, b), False))
        after = pc.or_(after, pc.and_(same, greater))
        same = pc.and_(same, pc.or_(pc.and_(a_null, b_null), pc.fill_null(pc.equal(a, b), False)))
    return after


def _ranges(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One line per file range: its place, first and last key, rows and places out of order."""
    first = last = None
    rows = breaks = 0

    def line() -> pa.RecordBatch:
        columns = {c: last.column(c) for c in _PLACE}
        columns |= {f"first_{k}": first.column(k) for k in keys} | {f"last_{k}": last.column(k) for k in keys}
        columns |= {"n_rows": pa.array([rows], pa.int64()), "n_breaks": pa.array([breaks], pa.int64())}
        return pa.table(columns).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = new if last is None else pa.concat_tables([last, new])
        if last is None:
            first, rows = new.slice(0, 1), 1
        if table.num_rows > 1:
            after = _neighbours(table, keys)
            ends = pc.indices_nonzero(_neighbours_differ(table)).to_pylist()  # last rows of ranges
            at = 0
            for end in [*ends, table.num_rows - 1]:
                rows += end - at
                breaks += pc.sum(after.slice(at, end - at).cast(pa.int64())).as_py() or 0
                if end < table.num_rows - 1:
                    last = table.slice(end, 1)
                    yield line()
                    first, rows, breaks = table.slice(end + 1, 1), 1, 0
                at = end + 1
        last = table.slice(table.num_rows - 1, 1)
    if last is not None:
        yield line()


def _neighbours_differ(table: pa.Table) -> pa.Array:
    """Whether each row lies in another file range than the next one."""
    parts = [table.column(c).combine_chunks() for c in _PLACE]
    return reduce(pc.or_, [pc.not_equal(p.slice(0, len(p) - 1), p.slice(1)) for p in parts])


def _comes_after(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Whether the left keys come after the right ones, nulls last."""
    after, same = F.lit(False), F.lit(True)
    for a, b in pairs:
        greater = (a.isNull() & b.isNotNull()) | F.coalesce(a > b, F.lit(False))
        after, same = after | (same & greater), same & a.eqNullSafe(b)
    return after


def range_lines(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """One line per file range of a written table; of Parquet files only the key columns are read."""
    read = read_format(spark, [path], fmt, schema, _places(), as_written=True)
    chosen = read.select(*_PLACE, *keys)
    kinds = {f.name: f.dataType for f in chosen.schema}
    out = T.StructType([T.StructField(c, T.LongType()) for c in _PLACE])
    for side in ("first", "last"):
        for k in keys:
            out = out.add(f"{side}_{k}", kinds[k])
    return chosen.mapInArrow(lambda batches: _ranges(batches, keys), out.add("n_rows", "long").add("n_breaks", "long"))


def written_order(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """(n_rows, n_breaks) of a written table: places where a row comes after the next one by ``keys``.

    Nulls come last.  Rows follow each other as they lie in the part files, in
    the order of the parts' numbers.  Equal rows are in order; a table without
    rows has no breaks.
    """
    lines = range_lines(spark, path, keys, fmt, schema)
    # One line per file range: few, so one task may bring them in order.
    before = Window.orderBy(*_PLACE)
    borders = lines.withColumns({f"_{k}": F.lag(f"last_{k}").over(before) for k in keys}).withColumn("_no", F.row_number().over(before))
    pairs = [(F.col(f"_{k}"), F.col(f"first_{k}")) for k in keys]
    broken = F.when((F.col("_no") > 1) & _comes_after(pairs), 1).otherwise(0)
    return borders.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n_breaks") + broken), F.lit(0)).cast("long").alias("n_breaks"),
    )


def check_written_order(spark: SparkSession, paths: Mapping[str, str], orders: Mapping[str, Sequence[str]], fmt: str = "parquet", schemas: Mapping[str, T.StructType] | None = None) -> None:
    """Refuse written tables, by name, that do not lie in their order."""
    found = {name: written_order(spark, path, orders[name], fmt, (schemas or {}).get(name)).first()["n_breaks"] for name, path in paths.items()}
    wrong = [f"{name} ({n} places)" for name, n in found.items() if n]
    if wrong:
        raise ValueError(f"not in order: {', '.join(wrong)}")
