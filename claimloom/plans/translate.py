"""Raw claims feeds to the nine tables, all subsamples in one run."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.joins import check_options
from claimloom.operators.rows import duplicate_keys, union_tagged
from claimloom.plans.claims import process_claims
from claimloom.plans.dispensing import build_dispensing
from claimloom.plans.enrollment import build_death, build_demographic, build_enrollment
from claimloom.plans.finalise import CLAIM_TABLES, finalise
from claimloom.schema import LOOKUP_FILES, TABLES
from claimloom.sources.readers import NAMED_MISSING, audit_completeness, found_pairs, missing_message, read_format, read_subsamples
from claimloom.sources.sinks import commit_set, write_numbered, write_table
from claimloom.workspace import Workspace, run_together

# The years of the beneficiary files, and the other feeds.
YEARS = (2008, 2009, 2010)
FEEDS = ("pde", "op", "car", "ip")


@dataclass
class Feeds:
    """Raw inputs; every frame carries samplenum.

    ``bene`` maps a year to its file.  The claims feeds may be left out when
    no table that comes from claims is asked for.
    """

    bene: dict[int, DataFrame]
    pde: DataFrame
    op: DataFrame | None = None
    car: DataFrame | None = None
    ip: DataFrame | None = None


@dataclass
class Lookups:
    """Code lists (ClinCode, ClinCodeCat, ClinCodeType) and the area to ZIP table (ssacd, ZIP)."""

    master: DataFrame
    ed: DataFrame
    home: DataFrame
    institutional: DataFrame
    zips: DataFrame


def translate(
    feeds: Feeds, lookups: Lookups, ws: Workspace, only: Collection[str] = tuple(TABLES), **options
) -> dict[str, DataFrame]:
    """The nine final tables (or those in ``only``), each with samplenum."""
    check_options(options)
    bene = union_tagged(feeds.bene, "YEAR")

    def claims():
        if not CLAIM_TABLES & set(only):
            return None
        lists = {"ed": lookups.ed, "home": lookups.home, "is": lookups.institutional}
        frames = {"OP": feeds.op, "CAR": feeds.car, "IP": feeds.ip}
        return process_claims(frames, lookups.master, lists, ws, **options)

    # Claims, enrolment and persons do not depend on each other.
    done, enrollment, demographic = run_together(
        [
            claims,
            lambda: ws.keep(build_enrollment(bene), "enrollment"),
            lambda: build_demographic(bene, lookups.zips, **options) if "demographic" in only else None,
        ]
    )
    death, dispensing = build_death(bene), build_dispensing(feeds.pde)
    keys = feeds.pde.select("samplenum", F.col("DESYNPUF_ID").alias("PatID"))
    return finalise(enrollment, demographic, death, dispensing, done, ws, only, keys, **options)


def repeated_people(table: DataFrame, **options) -> DataFrame:
    """Rows of persons with more than one demographic or death row, a data error to report."""
    return duplicate_keys(table, ["samplenum", "PatID"], **options)


def read_feeds(spark: SparkSession, in_dir: str, numbers: Sequence[int], fmt: str = "parquet") -> Feeds:
    """Raw feeds from ``bene_<year>_<n>``, ``pde_<n>``, ``op_<n>``, ``car_<n>`` and ``ip_<n>`` files."""
    bene = {y: read_subsamples(spark, in_dir, f"bene_{y}", numbers, fmt) for y in YEARS}
    return Feeds(bene, **{feed: read_subsamples(spark, in_dir, feed, numbers, fmt) for feed in FEEDS})


def read_lookups(spark: SparkSession, folder: str, fmt: str = "parquet") -> Lookups:
    """Code lists and area table from ``master``, ``ed``, ``home``, ``institutional`` and ``zips`` files."""
    return Lookups(**{
        name: read_format(spark, [f"{folder}/{name}.{fmt}"], fmt, T.StructType.fromDDL(ddl)) for name, ddl in LOOKUP_FILES.items()
    })


def translate_to_files(
    spark: SparkSession,
    in_dir: str,
    lookup_dir: str,
    out_dir: str,
    out_fmt: str = "parquet",
    fmt: str = "parquet",
    first: int | None = None,
    last: int | None = None,
    numbers: Sequence[int] | None = None,
    **options,
) -> dict[str, list[str]]:
    """Translate a folder of raw feeds into ``<table>_<n>.<fmt>`` files, which ``combine`` reads.

    Every feed of every subsample must be there.  Each table is written in one
    pass in its sort order, with a file for every subsample, also those without
    rows.  A manifest, written last, lists all files and their rows as read
    back; without it the set does not count as complete.  Persons with several demographic or death rows are
    reported in ``repeated_<table>.<fmt>``.  Returns the paths by table.
    """
    found = found_pairs(spark, in_dir, fmt)
    tables = [*[f"bene_{y}" for y in YEARS], *FEEDS]
    missing, wanted = audit_completeness(found.where(F.col("table_name").isin(tables)), tables, first, last, numbers)
    gaps = missing.orderBy("samplenum", "table_name").limit(NAMED_MISSING).collect()
    if gaps:
        raise ValueError(missing_message(in_dir, fmt, gaps, missing.count()))
    with Workspace(spark) as ws:
        done = translate(read_feeds(spark, in_dir, wanted, fmt), read_lookups(spark, lookup_dir, fmt), ws, **options)
        for name in ("demographic", "death"):
            done[name] = ws.keep(done[name], f"final-{name}")
        # One after the other: the disk holds what one table shuffles.
        paths = [write_numbered(df, name, out_fmt, out_dir, TABLES[name].order, wanted) for name, df in done.items()]
        reports = {}
        for name in ("demographic", "death"):
            repeated = repeated_people(done[name])
            if not repeated.isEmpty():
                reports[f"repeated_{name}"] = [f"{out_dir}/repeated_{name}.{out_fmt}"]
                write_table(repeated, reports[f"repeated_{name}"][0], out_fmt)
    counts = run_together([partial(_rows_by_number, spark, out_dir, name, wanted, out_fmt) for name in done])
    commit_set(spark, out_dir, out_fmt, {k: n for c in counts for k, n in c.items()})
    return {**dict(zip(done, paths)), **reports}


def _rows_by_number(spark: SparkSession, out_dir: str, name: str, numbers: Sequence[int], fmt: str) -> dict[tuple[str, int], int]:
    read = read_subsamples(spark, out_dir, name, numbers, fmt)
    found = {r["samplenum"]: r["count"] for r in read.groupBy("samplenum").count().collect()}
    return {(name, n): found.get(n, 0) for n in numbers}
