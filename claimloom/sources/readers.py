"""Numbered subsample files: discovery, completeness and tagged reading.

Nothing is lost on reading.  Ids keep the type the source has; in text files
that is text.  A value that does not fit its declared kind, or a row with a
wrong number of fields, is an error that names its file.  Files may differ in
columns, column order and types: they are read by groups of equal layout and
appended by name, so a plan grows with the number of layouts, not of files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schema import RAW_FEEDS, TABLES
from claimloom.sources import quoted_text
from claimloom.workspace import Workspace, hadoop_path, run_together

FORMATS = ("parquet", "csv", "json", "txt")

# Unquoted nothing is null and "" is an empty string, as long as no text is the null marker.
_NO_MARKER = ""

#: How both text formats are written and read.
TEXT_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def separator(fmt: str) -> str:
    return "\t" if fmt == "txt" else ","


def check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")


def _text_reader(spark: SparkSession, fmt: str):
    # A quoted value may hold line feeds, so a file is read from its beginning on.
    options = {**TEXT_OPTIONS, "sep": separator(fmt), "nullValue": _NO_MARKER, "multiLine": True}
    return spark.read.options(**options)


def _strictly(column: Column, name: str, kind: T.DataType) -> Column:
    """A text as ``kind``; a text that is none is an error that names file, column and value."""
    if isinstance(kind, T.StringType):
        return column
    value = column.try_cast(kind)
    told = F.concat(F.lit("not a value of type " + kind.simpleString() + " in column " + name + " of "), F.col("_metadata.file_path"), F.lit(": "), column)
    return F.when(column.isNotNull() & value.isNull(), F.raise_error(told).cast(kind)).otherwise(value)


def _json_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(_row, _metadata) of one document per line: its values as text by their names in lower case.

    Two names of a document that differ in case only, like a line that is no
    document, are an error.
    """
    lines = spark.read.text(list(paths)).where(F.trim("value") != "")
    row = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return lines.select(F.transform_keys(row, lambda k, _: F.lower(k)).alias("_row"), "_metadata")


def required_columns(table: str) -> list[str]:
    """Ids without which all rows of a table would vanish when it is combined."""
    return [c for c, how in TABLES[table].rekeyed.items() if how == "inner"] if table in TABLES else []


def _names_found(table: str) -> list[Column]:
    """Whether a document has each required column."""
    return [F.map_contains_key("_row", F.lit(c.lower())).alias(f"_has_{c}") for c in required_columns(table)]


def _check_json_names(rows: DataFrame, table: str) -> None:
    """A file with documents, none of which has a required column, is an error; one row per file comes back."""
    required = required_columns(table)
    if not required:
        return
    has = [F.bool_or(f"_has_{c}").alias(c) for c in required]
    for r in rows.groupBy("samplenum").agg(*has).orderBy("samplenum").collect():
        _require([c for c in required if r[c]], table, f"{table}_{r['samplenum']}.json")


def _require(names: Iterable[str], table: str, where: str) -> None:
    have = {n.lower() for n in names}
    lacking = [c for c in required_columns(table) if c.lower() not in have]
    if lacking:
        raise ValueError(f"no column {', '.join(lacking)} in {where}")


def _one_task_each(spark: SparkSession, paths: Sequence[str], fmt: str, header: Sequence[str]) -> DataFrame:
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return _text_reader(spark, fmt).schema(text).option("enforceSchema", False).option("mode", "FAILFAST").csv(list(paths))


def read_format(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str,
    schema: T.StructType | None = None,
    extra: Sequence[Column] = (),
    as_written: bool = False,
) -> DataFrame:
    """Read files of one layout.  Text formats need a schema, whose types are checked value by value.

    ``extra`` columns, which may use the path in ``_metadata``, come after the
    file's.  Large delimited files are cut, which loses the order of their
    rows; with ``as_written`` they are not, and all of ``_metadata`` is there.
    """
    check_format(fmt)
    paths = list(paths)
    if fmt == "parquet":
        frame = (spark.read if schema is None else spark.read.schema(schema)).parquet(*paths)
        return frame.select(*frame.columns, *extra)
    if schema is None:
        raise ValueError(f"{fmt} files need a schema")
    kinds = {f.name.lower(): f for f in schema}
    if fmt == "json":
        rows = _json_rows(spark, paths)
        columns = [_strictly(F.col("_row")[key], f.name, f.dataType).alias(f.name) for key, f in kinds.items()]
        return rows.select(*columns, *extra)
    else:
        header = _text_reader(spark, fmt).csv(paths[0]).columns
        if not as_written and quoted_text.largest_file(spark, paths) >= quoted_text.SPLIT_BYTES:
            options = {**TEXT_OPTIONS, "sep": separator(fmt), "nullValue": _NO_MARKER}
            frame = quoted_text.read_quoted(spark, paths, header, options)
        else:
            frame = _one_task_each(spark, paths, fmt, header)
    have = {c.lower(): c for c in header}
    columns = []
    for key, field in kinds.items():
        value = F.col(f"`{have[key]}`") if key in have else F.lit(None).cast("string")
        columns.append(_strictly(value, field.name, field.dataType).alias(field.name))
    return frame.select(*columns, *extra)


def listed_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder itself; a missing folder is an error."""
    path, system = hadoop_path(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)]


def found_pairs(spark: SparkSession, in_dir: str, fmt: str = "parquet") -> DataFrame:
    """(table_name, samplenum) of ``<table>_<n>.<fmt>`` in a folder; folders below it are not searched."""
    check_format(fmt)
    names = spark.createDataFrame([(n,) for n in listed_names(spark, in_dir)], "name string")
    pattern = rf"^([A-Za-z]\w*)_(\d+)\.{fmt}$"
    return (
        names.select(
            F.regexp_extract("name", pattern, 1).alias("table_name"),
            F.regexp_extract("name", pattern, 2).try_cast("int").alias("samplenum"),
        )
        .where(F.col("samplenum").isNotNull() & (F.col("table_name") != ""))
        .distinct()
    )


def parse_selection(text: str) -> list[int]:
    """``"5-12"`` or ``"1 3 5"`` to subsample numbers."""
    if "-" in text:
        first, last = (int(p) for p in text.split("-", 1))
        return list(range(first, last + 1))
    return [int(p) for p in text.split()]


def audit_completeness(
    found: DataFrame,
    tables: Iterable[str],
    first: int | None = None,
    last: int | None = None,
    numbers: Sequence[int] | None = None,
) -> tuple[DataFrame, Sequence[int]]:
    """Every missing (table_name, samplenum) pair of the wanted numbers, and these numbers.

    Wanted is the list ``numbers``, or the range from ``first`` to ``last``,
    which default to the lowest and highest number found.  Nothing found is an
    error.  A long range is neither built nor collected here.
    """
    lo, hi = found.agg(F.min("samplenum"), F.max("samplenum")).first()
    if lo is None:
        raise ValueError("no subsample files found")
    spark = found.sparkSession
    if numbers is None:
        wanted: Sequence[int] = range(lo if first is None else first, (hi if last is None else last) + 1)
        frame = spark.range(wanted.start, max(wanted.stop, wanted.start)).select(F.col("id").cast("int").alias("samplenum"))
    else:
        wanted = sorted(set(numbers))
        frame = spark.createDataFrame([(n,) for n in wanted], "samplenum int")
    pairs = frame.select(F.explode(F.lit(sorted(tables))).alias("table_name"), "samplenum")
    return pairs.join(found, ["table_name", "samplenum"], "left_anti"), wanted


#: Missing files that an error message lists by name.
NAMED_MISSING = 200


def missing_message(in_dir: str, fmt: str, gaps: Sequence[Row], total: int | None = None) -> str:
    names = "\n".join(f"{in_dir}/{r['table_name']}_{r['samplenum']}.{fmt}" for r in gaps[:NAMED_MISSING])
    total = len(gaps) if total is None else total
    more = f"\n... and {total - NAMED_MISSING} more" if total > NAMED_MISSING else ""
    return f"missing subsample files ({total}):\n{names}{more}"


def declared_schema(table: str, id_type: T.DataType | None = None) -> T.StructType:
    """Declared columns of a common-model table or a raw feed; ids are text unless told otherwise."""
    if table in TABLES:
        return TABLES[table].struct(id_type or T.StringType(), samplenum=False)
    feed = table if table in RAW_FEEDS else table.rsplit("_", 1)[0]
    if feed not in RAW_FEEDS:
        raise ValueError(f"unknown table: {table}")
    return T.StructType.fromDDL(RAW_FEEDS[feed])


def read_subsamples(
    spark: SparkSession,
    in_dir: str,
    table: str,
    numbers: Sequence[int],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    id_type: T.DataType | None = None,
    ws: Workspace | None = None,
) -> DataFrame:
    """Read ``<table>_<n>.<fmt>`` for all numbers as one relation with its samplenum.

    The number is taken from the path of the file a row is in.  Text formats
    are read by the names in their header or documents, in any letter case,
    with the table's declared types; columns the declaration lacks are left
    out, missing ones are null.  Parquet keeps its own columns and types; of
    differing ones the wider counts.  A file without an id that its rows are
    matched by is an error.  With ``ws`` JSON documents are parsed and checked
    once, into a written table that later steps read.
    """
    check_format(fmt)
    paths = [f"{in_dir}/{table}_{n}.{fmt}" for n in numbers]
    if not paths:
        declared = schema or declared_schema(table, id_type)
        return spark.createDataFrame([], T.StructType(list(declared)).add("samplenum", T.IntegerType()))
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"{table}_(\d+)\.{fmt}(/[^/]*)?$", 1).cast("int").alias("samplenum")
    if fmt == "json":
        schema = schema or declared_schema(table, id_type)
        if ws is None:
            _check_json_names(_json_rows(spark, paths).select(number, *_names_found(table)), table)
            return read_format(spark, paths, fmt, schema, [number])
        kept = ws.keep(read_format(spark, paths, fmt, schema, [number, *_names_found(table)]), f"read-{table}")
        _check_json_names(kept, table)
        return kept.drop(*[f"_has_{c}" for c in required_columns(table)])
    if fmt == "parquet":
        layouts = run_together([partial(lambda p: spark.read.parquet(p).schema, p) for p in paths])
        key = [tuple((f.name, f.dataType.simpleString()) for f in s) for s in layouts]
    else:
        schema = schema or declared_schema(table, id_type)
        key = run_together([partial(lambda p: tuple(_text_reader(spark, fmt).csv(p).columns), p) for p in paths])
    groups: dict[tuple, list[str]] = {}
    for k, path in zip(key, paths):
        _require([c if isinstance(c, str) else c[0] for c in k], table, path)
        groups.setdefault(k, []).append(path)
    frames = [read_format(spark, group, fmt, schema, [number]) for group in groups.values()]
    ids = [f for f, kind in TABLES[table].fields.items() if kind == "id"] if table in TABLES else []
    return union_harmonised(frames, ids)


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both; text holds anything."""
    if a == b:
        return a
    rank = {t: i for i, t in enumerate(_WIDTH)}
    if type(a) in rank and type(b) in rank:
        wide = max(a, b, key=lambda t: rank[type(t)])
        narrow = min(a, b, key=lambda t: rank[type(t)])
        return T.DoubleType() if isinstance(wide, T.FloatType) and rank[type(narrow)] >= 2 else wide
    numeric = (T.DecimalType, *_WIDTH)
    if isinstance(a, numeric) and isinstance(b, numeric):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (a, b)]
        whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    dates = (T.DateType, T.TimestampType)
    if isinstance(a, dates) and isinstance(b, dates):
        return T.TimestampType()
    return T.StringType()


def union_harmonised(frames: Sequence[DataFrame], ids: Iterable[str] = ()) -> DataFrame:
    """Append frames by name: the first one's column order, new columns last.

    Names match ignoring case, each column takes the widest type, and a column
    one frame lacks is null there.  An id that would become a floating-point
    number is an error, since large ids would fall together.
    """
    if len(frames) == 1:
        return frames[0]
    fields = [{f.name.lower(): f for f in df.schema} for df in frames]
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for own in fields:
        for k, f in own.items():
            names.setdefault(k, f.name)
            kinds[k] = wider_type(kinds[k], f.dataType) if k in kinds else f.dataType
    for k in {i.lower() for i in ids} & set(kinds):
        if isinstance(kinds[k], (T.FloatType, T.DoubleType)):
            raise ValueError(f"id column {names[k]} would become a floating-point number")
    order = [k for k in names if k != "samplenum"] + ["samplenum"] * ("samplenum" in names)

    def shaped(df: DataFrame, own: dict) -> DataFrame:
        return df.select(*[(F.col(f"`{own[k].name}`") if k in own else F.lit(None)).cast(kinds[k]).alias(names[k]) for k in order])

    return reduce(DataFrame.unionByName, [shaped(df, own) for df, own in zip(frames, fields)])


def append_harmonised(base: DataFrame, nxt: DataFrame) -> DataFrame:
    """Append one frame to another, see ``union_harmonised``."""
    return union_harmonised([base, nxt])
