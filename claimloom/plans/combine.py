"""Combine subsamples: crosswalks, re-keyed tables and the two tables made from crosswalks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.ids import Crosswalk, build_crosswalk
from claimloom.operators.joins import check_options, is_cheap
from claimloom.operators.rows import contract_select, drop_null_ids, sort_contract, with_constants
from claimloom.schema import CROSSWALKS, SOURCED_TABLES, TABLES, TableSpec
from claimloom.sources.readers import NAMED_MISSING, audit_completeness, check_format, found_pairs, missing_message, read_subsamples
from claimloom.sources.sinks import committed_set, export_all
from claimloom.workspace import Workspace, run_together

# Every provider and facility row carries these.
PROVIDER_FIELDS = {"Specialty": "99", "Specialty_CodeType": "2"}
FACILITY_FIELDS = {"Facility_Location": ""}


def build_crosswalks(sources: dict[str, DataFrame], ws: Workspace) -> dict[str, Crosswalk]:
    """Crosswalks by id column, for each whose source table is present."""
    specs = [spec for spec in CROSSWALKS.values() if spec.source_table in sources]
    built = run_together([partial(build_crosswalk, sources[s.source_table], s.id_column, ws) for s in specs])
    return {spec.id_column: crosswalk for spec, crosswalk in zip(specs, built)}


def get_crosswalk(crosswalks: dict[str, Crosswalk], name: str) -> DataFrame:
    """A crosswalk's rows by its table name, such as ``patid_crosswalk``."""
    by_name = {spec.name: spec.id_column for spec in CROSSWALKS.values()}
    if name not in by_name:
        raise ValueError(f"unknown crosswalk: {name}")
    return crosswalks[by_name[name]].frame


def assemble(source: DataFrame, spec: TableSpec, crosswalks: dict[str, Crosswalk], ordered: bool = True, **options) -> DataFrame:
    """Re-key one table's ids and project it to its contract, optionally in its sort order.

    Ids joined ``inner`` drop rows without a match; ``left`` ids become null.
    """
    check_options(options)
    missing = [c for c in spec.rekeyed if c not in crosswalks]
    if missing:
        raise ValueError(f"no crosswalk for: {', '.join(missing)}")
    original = keyed = contract_select_with_sample(source, spec)
    # Frequent keys are looked for in a source that is only read. One that has to be computed would be
    # computed, and shuffled, for each id once more; Spark splits its large partitions when it has run.
    keys_from = original if is_cheap(original) else None
    for id_column, how in spec.rekeyed.items():
        keyed = crosswalks[id_column].apply(keyed, how, keys_from=keys_from, **options)
    table = contract_select(keyed, spec)
    return sort_contract(table, spec) if ordered else table


def contract_select_with_sample(source: DataFrame, spec: TableSpec) -> DataFrame:
    """The contract columns a source has, and samplenum: nothing else is read or shuffled."""
    have = {c.lower(): c for c in source.columns}
    return source.select(*[F.col(have[c.lower()]).alias(c) for c in spec.columns if c.lower() in have], "samplenum")


def synthesise(crosswalks: dict[str, Crosswalk]) -> dict[str, DataFrame]:
    """Provider and facility tables from their crosswalks."""
    out = {}
    for name, fixed in (("provider", PROVIDER_FIELDS), ("facility", FACILITY_FIELDS)):
        spec = TABLES[name]
        id_column = spec.sort_keys[0]
        if id_column in crosswalks:
            ids = drop_null_ids(crosswalks[id_column].frame, f"orig_{id_column}").select(id_column)
            out[name] = sort_contract(contract_select(with_constants(ids, fixed), spec), spec)
    return out


def combine_frames(sources: dict[str, DataFrame], ws: Workspace, ordered: bool = True, **options) -> dict[str, DataFrame]:
    """Combine tagged source tables; tables without a source are skipped."""
    crosswalks = build_crosswalks(sources, ws)
    out = {
        name: assemble(sources[name], TABLES[name], crosswalks, ordered, **options)
        for name in SOURCED_TABLES
        if name in sources
    }
    return {**out, **synthesise(crosswalks)}


def export_combined(
    tables: dict[str, DataFrame], out_dir: str, fmt: str, ws: Workspace, mode: str = "errorifexists"
) -> list[str]:
    """Write combined tables to ``<out_dir>/<table>.<fmt>``, each in its sort order, and return the paths.

    A table is written as its joins leave it and sorted from there: the files
    its joins shuffled are gone when the sort shuffles, and the joins do not
    run a second time to find the ranges of the sort.
    """
    check_format(fmt)
    paths = []
    for name, df in tables.items():
        with Workspace(ws.spark, ws.path) as own:
            kept = own.keep(df, f"rekeyed-{name}")
            paths += export_all({name: sort_contract(kept, TABLES[name])}, out_dir, fmt, mode)
    return paths


def combine(
    spark: SparkSession,
    in_dir: str,
    ws: Workspace,
    first: int | None = None,
    last: int | None = None,
    numbers: Sequence[int] | None = None,
    fmt: str = "parquet",
    id_type: T.DataType | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Combine the subsample files ``<table>_<n>.<fmt>`` of a folder into the nine tables.

    Subsamples are those from ``first`` to ``last`` or those in ``numbers``.
    Every file of them must be there; missing ones are reported.  A folder in
    which files are still being written is refused, and so are files that its
    manifest, if there is one, does not list.  Files may
    differ in columns and types.  Ids in text files are text unless ``id_type``
    says otherwise.
    """
    found = found_pairs(spark, in_dir, fmt)
    missing, wanted = audit_completeness(found, list(TABLES), first, last, numbers)
    gaps = missing.orderBy("samplenum", "table_name").limit(NAMED_MISSING).collect()
    if gaps:
        raise ValueError(missing_message(in_dir, fmt, gaps, missing.count()))
    listed = committed_set(spark, in_dir, fmt)
    strange = [] if listed is None else [(t, n) for t in TABLES for n in wanted if (t, n) not in listed]
    if strange:
        raise ValueError(f"not in the manifest of {in_dir}: " + ", ".join(f"{t}_{n}.{fmt}" for t, n in strange[:NAMED_MISSING]))
    read = run_together([partial(read_subsamples, spark, in_dir, name, wanted, fmt, id_type=id_type, ws=ws) for name in TABLES])
    return combine_frames(dict(zip(TABLES, read)), ws, **options)


def combine_to_files(
    spark: SparkSession, in_dir: str, out_dir: str, out_fmt: str, mode: str = "errorifexists", **selection
) -> list[str]:
    """Combine a folder's subsamples and write the nine tables in one format."""
    with Workspace(spark) as ws:
        return export_combined(combine(spark, in_dir, ws, ordered=False, **selection), out_dir, out_fmt, ws, mode)
