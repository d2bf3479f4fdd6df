"""Delimited text whose quoted values hold line feeds, read by many tasks.

A task that begins in the middle of a file cannot know whether it stands inside
a quoted value.  So the lines of each byte range are first only counted: every
range yields the parity of its quotes.  Running parities over the ranges of a
file, one line per range, tell where each range begins, inside or outside.
Then each range tells its records; only the lines of records of several lines
meet in another shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.workspace import hadoop_path

#: Files from this size on are cut.  Cutting costs several times the CPU of
#: reading from the beginning, so smaller ones are read by one task each.
SPLIT_BYTES = 1024 * 1024 * 1024

_RANGE = ("_file", "_start")
_QUOTE = '"'


#: A compressed file can only be read from its beginning on, whatever its size.
_COMPRESSED = (".gz", ".deflate", ".bz2", ".lz4", ".snappy", ".zst")


def largest_file(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of the largest file that can be cut among paths of files and folders."""
    sizes = [0]
    for path in paths:
        target, system = hadoop_path(spark, path)
        sizes += [s.getLen() for s in system.listStatus(target) if s.isFile() and not s.getPath().getName().endswith(_COMPRESSED)]
    return max(sizes)


def _ranged_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its file, byte range, place in it, and quotes of the range before it."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").cast("long").alias("_start"),
        # Grows with the rows of a range; only that order is used.
        F.monotonically_increasing_id().alias("_no"),
        F.col("value").alias("_line"),
    )
    quotes = F.length("_line") - F.length(F.replace(F.col("_line"), F.lit(_QUOTE), F.lit("")))
    blank = F.col("_line").isin("", "\r")
    before = Window.partitionBy(*_RANGE).orderBy("_no").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("_quotes", quotes.cast("long")).withColumn("_blank", blank)
    return counted.withColumn("_before", F.coalesce(F.sum("_quotes").over(before), F.lit(0)))


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per byte range: whether it begins inside quotes, and the record, if any, that its first lines belong to."""

    def starts(parity: int) -> Column:
        return F.count_if(~F.col("_blank") & (F.col("_before") % 2 == parity))

    found = lines.groupBy(*_RANGE).agg(F.sum("_quotes").alias("_all"), starts(0).alias("_even"), starts(1).alias("_odd"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("_all").over(earlier), F.lit(0)) % 2) == 1
    # The last record that begins in a range.
    begun = F.when(F.col("_inside"), F.col("_odd")).otherwise(F.col("_even"))
    own = F.when(begun > 0, F.struct(F.col("_start").alias("start"), begun.alias("record")))
    unpaired = F.concat(F.lit("a quoted value has no end in "), F.col("_file"))
    odd = F.sum("_all").over(Window.partitionBy("_file")) % 2 == 1
    return (
        found.withColumn("_inside", inside)
        .withColumn("_open", F.last(own, ignorenulls=True).over(earlier))
        .withColumn("_unpaired", odd)
        .select(*_RANGE, "_open", F.when(F.col("_unpaired"), F.raise_error(unpaired).cast("boolean")).otherwise(F.col("_inside")).alias("_inside"))
    )


def _without_return(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(_file, _start, _record, _text): the records of text files, numbered from 1 within the byte range they begin in.

    Blank lines between records are left out, as are carriage returns at their
    ends.  A file whose quotes do not pair is an error.  Only lines of records
    of several lines are shuffled a second time.
    """
    lines = _ranged_lines(spark, paths)
    placed = lines.join(_ranges(lines), list(_RANGE))
    outside = (F.col("_before") % 2 == 1) == F.col("_inside")
    upto = Window.partitionBy(*_RANGE).orderBy("_no")
    numbered = (
        placed.where(~(outside & F.col("_blank")))
        .withColumn("_begins", outside)
        .withColumn("_record", F.sum(F.when(F.col("_begins"), 1).otherwise(0)).over(upto).cast("long"))
    )
    single = F.col("_begins") & (F.col("_quotes") % 2 == 0)
    whole = numbered.where(single).select(*_RANGE, "_record", _without_return(F.col("_line")).alias("_text"))
    # Lines before the first record of a range are the rest of an earlier range's last one.
    rest = F.col("_record") == 0
    parts = numbered.where(~single).select(
        "_file",
        F.when(rest, F.col("_open.start")).otherwise(F.col("_start")).alias("_owner"),
        F.when(rest, F.col("_open.record")).otherwise(F.col("_record")).alias("_record"),
        F.struct(F.col("_start").alias("start"), F.col("_no").alias("no"), F.col("_line").alias("line")).alias("_part"),
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("_part")), lambda p: p["line"]), "\n")
    joined = parts.groupBy("_file", F.col("_owner").alias("_start"), "_record").agg(text.alias("_text"))
    return whole.unionByName(joined.withColumn("_text", _without_return(F.col("_text"))))


def read_quoted(spark: SparkSession, paths: Sequence[str], header: Sequence[str], options: Mapping[str, object]) -> DataFrame:
    """Text columns of files with the given header line, and ``_metadata`` with their file's path.

    Row order is not kept.  A file with another header or a row with a wrong
    number of fields is an error.
    """
    columns = ", ".join(f"`{c}` string" for c in header)
    settings = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in ("header", "multiLine")}
    settings |= {"mode": "FAILFAST", "lineSep": "\n", "multiLine": "true"}
    parsed = quoted_records(spark, paths).withColumn("_row", F.from_csv("_text", columns, settings))
    is_header = (F.col("_start") == 0) & (F.col("_record") == 1)
    same = F.array(*[F.col("_row")[c] for c in header]) == F.array(*[F.lit(c) for c in header])
    other = F.concat(F.lit("another header in "), F.col("_file"))
    keep = F.when(~is_header, F.lit(True)).when(same, F.lit(False)).otherwise(F.raise_error(other).cast("boolean"))
    path = F.struct(F.col("_file").alias("file_path")).alias("_metadata")
    return parsed.where(keep).select(*[F.col("_row")[c].alias(c) for c in header], path)

