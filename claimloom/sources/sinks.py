"""Parquet, CSV, tab-delimited and newline-delimited JSON output.

Spark writes a folder of part files where a single-machine tool writes one
file; the folder carries the file's name, ``<table>.<format>``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources.readers import TEXT_OPTIONS, check_format, listed_names, parse_selection, read_format, separator
from claimloom.workspace import hadoop_path, run_together, shuffles_dropped

# Tables large enough to be exported to a folder of their own.
_OWN_FOLDER = ("diagnosis", "procedure")
#: Text files with quoted line feeds are read whole by one task, so they are kept moderate.
TEXT_ROWS_PER_FILE = 2_000_000


def write_table(
    df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", compression: str | None = None
) -> None:
    """Write a table; every text, null and empty string comes back as it was in every format.

    ``compression`` is that of text formats, such as ``gzip``; they are plain
    text without it.  What the table shuffled is deleted when it is written.
    """
    check_format(fmt)
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if compression is not None and fmt != "parquet":
        # A compressed file is read by one task, of any text format.
        writer = writer.options(compression=compression, maxRecordsPerFile=TEXT_ROWS_PER_FILE)
    with shuffles_dropped(df.sparkSession):
        if fmt == "parquet":
            writer.option("compression", "zstd").parquet(path)
        elif fmt == "json":
            writer.option("ignoreNullFields", "false").json(path)
        else:
            # A null is written as nothing, an empty string as "".
            options = {**TEXT_OPTIONS, "emptyValue": '""', "maxRecordsPerFile": TEXT_ROWS_PER_FILE}
            writer.options(**options).csv(path, sep=separator(fmt))


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_table`` wrote."""
    return read_format(spark, [path], fmt, schema)


def export_all(tables: dict[str, DataFrame], out_dir: str, fmt: str, mode: str = "errorifexists") -> list[str]:
    """Write every table to ``<out_dir>/<table>.<fmt>`` and return the paths.

    One table is written after the other, so the disk holds what one of them
    shuffles, not what all do.
    """
    check_format(fmt)
    paths = {name: f"{out_dir}/{name}.{fmt}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], fmt, mode=mode)
    return list(paths.values())


def write_numbered(
    df: DataFrame,
    table: str,
    fmt: str,
    out_dir: str,
    order: Sequence[str] = (),
    numbers: Iterable[int] | None = None,
    compression: str | None = None,
) -> list[str]:
    """Write ``<out_dir>/<table>_<n>.<fmt>`` for every subsample, in one pass, without the samplenum column.

    Part files of a subsample follow the given order, nulls last.  With
    ``numbers``, these subsamples get a file even if they have no rows, and
    others are an error.  An existing file is an error, found before anything
    is moved to its place.  While a table is written its parts lie in a folder
    ``_writing_<table>_<fmt>``, so an interrupted run can be told.  Text may be
    written with ``compression``.
    """
    check_format(fmt)
    spark = df.sparkSession
    aside = f"{out_dir}/_writing_{table}_{fmt}"
    if order:
        keys = [F.col(c).asc_nulls_last() for c in ("samplenum", *order)]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    write_table(df, aside, fmt, ["samplenum"], compression=compression)
    found = sorted(int(n.split("=", 1)[1]) for n in listed_names(spark, aside) if n.startswith("samplenum="))
    wanted = found if numbers is None else sorted(set(numbers))
    if not set(found) <= set(wanted):
        raise ValueError(f"{table} has rows of other subsamples: {sorted(set(found) - set(wanted))}")
    nothing = spark.createDataFrame([], df.drop("samplenum").schema).coalesce(1)
    for n in sorted(set(wanted) - set(found)):
        write_table(nothing, f"{aside}/samplenum={n}", fmt, compression=compression)
    paths = {n: f"{out_dir}/{table}_{n}.{fmt}" for n in wanted}
    for path in paths.values():
        target, system = hadoop_path(spark, path)
        if system.exists(target):
            raise FileExistsError(path)
    for n, path in paths.items():
        target, system = hadoop_path(spark, path)
        source, _ = hadoop_path(spark, f"{aside}/samplenum={n}")
        if not system.rename(source, target):
            raise OSError(f"cannot move {source} to {path}")
    folder, system = hadoop_path(spark, aside)
    system.delete(folder, True)
    return list(paths.values())


def _manifest(out_dir: str, fmt: str) -> str:
    return f"{out_dir}/_manifest_{fmt}.json"


def commit_set(spark: SparkSession, out_dir: str, fmt: str, rows: dict[tuple[str, int], int]) -> str:
    """Write the manifest of a complete set of numbered files: (table, subsample) and its number of rows.

    The manifest is written aside and moved to its place, so it is there whole
    or not at all; it comes last, so a set without one is not complete.
    """
    path = _manifest(out_dir, fmt)
    lines = [(t, n, count) for (t, n), count in sorted(rows.items())]
    listed = spark.createDataFrame(lines, "table_name string, samplenum int, rows long").coalesce(1)
    listed.write.mode("overwrite").json(f"{path}.writing")
    source, system = hadoop_path(spark, f"{path}.writing")
    target, _ = hadoop_path(spark, path)
    system.delete(target, True)
    if not system.rename(source, target):
        raise OSError(f"cannot move {source} to {path}")
    return path


def committed_set(spark: SparkSession, in_dir: str, fmt: str) -> dict[tuple[str, int], int] | None:
    """The manifest of a folder, None if it has none; files that are being written are an error."""
    names = listed_names(spark, in_dir)
    unfinished = [n for n in names if n.startswith("_writing_") and n.endswith(f"_{fmt}")]
    if unfinished:
        raise ValueError(f"a set of files was not finished: {in_dir}/{sorted(unfinished)[0]}")
    if _manifest("", fmt)[1:] not in names:
        return None
    listed = spark.read.schema("table_name string, samplenum int, rows long").json(_manifest(in_dir, fmt))
    # One row per file.
    return {(r["table_name"], r["samplenum"]): r["rows"] for r in listed.collect()}


def export_selection(
    tables: dict[str, DataFrame],
    subsamples: str | Iterable[int],
    names: Sequence[str],
    fmts: Sequence[str],
    out_dir: str,
) -> list[str]:
    """Write chosen subsamples of chosen tables in chosen formats.

    ``subsamples`` is a list, or text such as ``"5-12"`` or ``"1 3 5"``.  Each
    table is read once per format and written as ``<table>_<n>.<fmt>`` below
    ``subsamples_<fmt>``; diagnoses and procedures go to ``diagnosis_<fmt>``
    and ``procedure_<fmt>``.  A chosen subsample without rows gets a file
    without rows.  Such files can be read and combined again.
    """
    numbers = parse_selection(subsamples) if isinstance(subsamples, str) else list(subsamples)
    unknown = [n for n in names if n not in tables]
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    for fmt in fmts:
        check_format(fmt)

    def one(name: str, fmt: str) -> list[str]:
        chosen = tables[name].where(F.col("samplenum").isin(*numbers))
        return write_numbered(chosen, name, fmt, f"{out_dir}/{name if name in _OWN_FOLDER else 'subsamples'}_{fmt}", numbers=numbers)

    return [p for paths in run_together([partial(one, n, f) for n in names for f in fmts]) for p in paths]


def export_stats(
    stats: DataFrame,
    out_dir: str,
    fmts: Sequence[str] = ("json", "csv", "txt"),
    mode: str = "errorifexists",
    thousands: bool = False,
) -> list[str]:
    """Write the descriptive statistics in each format, on request as text with thousands commas."""
    if thousands:
        stats = stats.select(*[F.format_number(c, 0).alias(c) if c != "SubSample" else F.col(c) for c in stats.columns])
    paths = []
    for fmt in fmts:
        paths.append(f"{out_dir}/descriptive_stats_{fmt}/descriptive_stats.{fmt}")
        write_table(stats, paths[-1], fmt, mode=mode)
    return paths
