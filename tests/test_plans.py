import datetime as dt

import pytest
from conftest import rows_of

from claimloom.catalog.fixtures import DX_CODE, PX_CODE, Driver
from claimloom.catalog.queries import QUERIES, content
from claimloom.plans import claims, combine, stats, translate
from claimloom.schema import SOURCED_TABLES, TABLES
from claimloom.sources.sinks import read_table
from claimloom.workspace import Workspace, shared_root

SF = "/root/testdata/sf0.001"


@pytest.fixture
def driver(spark, ws):
    return Driver(spark, SF, ws)


@pytest.fixture
def two_samples(spark, ws, tmp_path):
    """Two subsamples with colliding ids and missing ids, as files."""
    folder = str(tmp_path / "in")
    for n in (1, 2):
        for name, spec in TABLES.items():
            rows = []
            for i in (3, 1, 2, None):
                row = []
                for column, kind in spec.fields.items():
                    if kind == "id":
                        row.append(i if column == "PatID" or i != 2 else None)
                    else:
                        row.append({"date": dt.date(2009, 1, (i or 0) + 1), "long": i or 0, "str": f"v{i}"}[kind])
                rows.append(tuple(row))
            spark.createDataFrame(rows, spec.struct(samplenum=False)).coalesce(1).write.parquet(f"{folder}/{name}_{n}.parquet")
    return folder


def test_combine_files(spark, ws, two_samples):
    out = combine.combine(spark, two_samples, ws)
    assert list(out) == [*SOURCED_TABLES, "provider", "facility"]
    assert all(tuple(df.columns) == TABLES[n].columns for n, df in out.items())
    # 3 known patients in each subsample; rows without one are dropped.
    assert [r["PatID"] for r in out["demographic"].collect()] == [1, 2, 3, 4, 5, 6]
    enc = [(r["PatID"], r["EncounterID"], r["FacilityID"]) for r in out["encounter"].collect()]
    assert enc == [(1, 1, 1), (2, None, None), (3, 2, 2), (4, 3, 3), (5, None, None), (6, 4, 4)]
    # The provider of a dispensing stays as it was.
    assert sorted(r["ProviderID"] or 0 for r in out["dispensing"].collect()) == [0, 0, 1, 1, 3, 3]
    assert rows_of(out["provider"]) == [(i, "99", "2") for i in (1, 2, 3, 4)]
    assert rows_of(out["facility"]) == [(i, "") for i in (1, 2, 3, 4)]


def test_combine_names_missing_files(spark, ws, two_samples):
    with pytest.raises(ValueError, match=r"death_3\.parquet(.|\n)*encounter_3\.parquet"):
        combine.combine(spark, two_samples, ws, last=3)


def test_combine_of_listed_numbers(spark, ws, two_samples):
    out = combine.combine(spark, two_samples, ws, numbers=[2])
    assert [r["PatID"] for r in out["demographic"].collect()] == [1, 2, 3]
    with pytest.raises(ValueError, match=r"death_7\.parquet"):
        combine.combine(spark, two_samples, ws, numbers=[1, 7])


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_command_writes_nine_tables(spark, two_samples, tmp_path, fmt):
    from claimloom.__main__ import main

    paths = main(["--input", two_samples, "--output", str(tmp_path / "out"), "--format", fmt])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(f"{t}.{fmt}" for t in TABLES)
    back = read_table(spark, paths[1], fmt, TABLES["demographic"].struct(samplenum=False))
    assert [r["PatID"] for r in back.orderBy("PatID").collect()] == [1, 2, 3, 4, 5, 6]


def test_combine_skips_absent_tables_and_knows_its_crosswalks(driver, ws):
    out = combine.combine_frames({"demographic": driver.demographic()}, ws)
    assert list(out) == ["demographic"]
    crosswalks = combine.build_crosswalks({"demographic": driver.demographic()}, ws)
    assert combine.get_crosswalk(crosswalks, "patid_crosswalk").columns == ["orig_PatID", "samplenum", "PatID"]
    with pytest.raises(ValueError, match="unknown crosswalk"):
        combine.get_crosswalk(crosswalks, "nope")
    with pytest.raises(ValueError, match="EncounterID"):
        combine.assemble(driver.encounter(), TABLES["encounter"], crosswalks)


def test_combine_is_the_same_on_the_shuffle_path(driver, ws, shuffled):
    sources = {n: driver.source(n) for n in TABLES}
    got = combine.combine_frames(sources, ws, ordered=False)
    plain = {n: rows_of(df) for n, df in combine.combine_frames(sources, ws, ordered=False, small_bytes=1 << 40).items()}
    for name, df in got.items():
        assert rows_of(df) == plain[name], name


def test_translate_is_the_same_on_the_shuffle_path(driver, ws, shuffled):
    got = content(translate.translate(driver.feeds(), driver.lookups(), ws), ["samplenum"])
    want = QUERIES["translate_e2e"](driver.spark, SF)
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_settings_of_one_join_are_refused_for_all(driver, ws):
    with pytest.raises(ValueError, match="right_bytes"):
        combine.combine_frames({"demographic": driver.demographic(), "enrollment": driver.enrollment()}, ws, right_bytes=0)
    with pytest.raises(ValueError, match="keys_from"):
        translate.translate(driver.feeds(), driver.lookups(), ws, keys_from=None)


def test_translated_files_are_sorted_report_repeats_and_can_be_combined(spark, driver, ws, tmp_path):
    from claimloom.__main__ import main
    from claimloom.schema import LOOKUP_FILES
    from claimloom.sources import sinks

    raw, lists, out = (str(tmp_path / n) for n in ("raw", "lists", "out"))
    bene = driver.bene_years()
    # One person of subsample 1 has two birth dates and two death dates.
    twice = bene[2010].where("samplenum = 1").limit(1).selectExpr(
        *[f"date'1950-01-01' as {c}" if c == "BENE_BIRTH_DT" else f"date'2010-05-05' as {c}" if c == "BENE_DEATH_DT" else c for c in bene[2010].columns]
    )
    bene[2010] = bene[2010].unionByName(twice).unionByName(twice.selectExpr("* except (BENE_DEATH_DT)", "date'2010-06-06' as BENE_DEATH_DT"))
    for name, df in {**{f"bene_{y}": df for y, df in bene.items()}, "pde": driver.pde(), **driver.claim_feeds()}.items():
        sinks.write_numbered(df, name, "json", raw)
    for name in LOOKUP_FILES:
        sinks.write_table(getattr(driver.lookups(), name), f"{lists}/{name}.json", "json")
    main(["translate", "--input", raw, "--lookups", lists, "--output", out, "--format", "csv", "--input-format", "json"])
    names = {p.name for p in (tmp_path / "out").iterdir()}
    assert {f"{t}_{n}.csv" for t in TABLES for n in (1, 2, 3)} <= names
    assert {n for n in names if n.startswith("repeated")} <= {"repeated_demographic.csv", "repeated_death.csv"} and len(names) > 27
    import csv

    for table, keys in (("encounter", ("PatID", "ADate")), ("dispensing", ("PatID", "RxDate"))):
        got = []
        for part in sorted((tmp_path / "out" / f"{table}_2.csv").glob("part-*.csv")):
            with open(part, newline="") as f:
                got += [(int(r[keys[0]]), r[keys[1]]) for r in csv.DictReader(f)]
        assert got and got == sorted(got)
    done = combine.combine(spark, out, ws, fmt="csv")
    assert done["encounter"].count() > 0 and len(done) == 9


def test_repeated_people(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "a", 3)], "samplenum int, PatID string, v int")
    assert {r["v"] for r in translate.repeated_people(df).collect()} == {1, 2}


def header_parts(spark):
    op = spark.createDataFrame(
        [(1, "p", f"c{i}", dt.date(2009, 1, 5), 1, " ", None, None, "F1") for i in range(4)]
        + [(1, "p", "c0", dt.date(2009, 1, 6), 2, "N9", None, None, "F1")],
        "samplenum int, DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT date, SEGMENT int, AT_PHYSN_NPI string,"
        " OP_PHYSN_NPI string, OT_PHYSN_NPI string, PRVDR_NUM string",
    )
    flags = spark.createDataFrame(
        [(1, f, "p", c, *x) for f in ("OP", "CAR") for c, x in (("c0", (True, True, False)), ("c1", (False, False, True)), ("c2", (False, False, False)))],
        "samplenum int, feed string, PatID string, EncounterID string, ind_ed boolean, ind_home boolean, ind_is boolean",
    )
    return op, flags


def test_outpatient_and_carrier_classes(spark):
    op, flags = header_parts(spark)
    got = {r["EncounterID"]: (r["EncType"], r["Provider"], r["ADate"].day) for r in claims.classify_op(op, flags).collect()}
    assert got == {"c0": ("ED", "F1", 5), "c1": ("OA", "F1", 5), "c2": ("AV", "F1", 5), "c3": ("AV", "F1", 5)}
    car = op.where("SEGMENT = 1").selectExpr("samplenum", "DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "AT_PHYSN_NPI as PRF_PHYSN_NPI_1", "OP_PHYSN_NPI as TAX_NUM_1")
    got = {r["EncounterID"]: (r["EncType"], r["Provider"]) for r in claims.classify_car(car, flags).collect()}
    assert got == {"c0": ("OA", "UNKNOWN"), "c1": ("OA", "UNKNOWN"), "c2": ("AV", "UNKNOWN"), "c3": ("AV", "UNKNOWN")}


def test_inpatient_classes(spark, ws):
    op, flags = header_parts(spark)
    visits = claims.classify_op(op, flags)  # one OA visit on 5 January
    stays = [("long", 3, 6), ("short", 4, 6), ("edge", 5, 9), ("after", 6, 20), ("before", 1, 4)]
    ip = spark.createDataFrame(
        [(1, "p", c, dt.date(2009, 1, a), dt.date(2009, 1, b), 1, "N1", None, None, " ", "123") for c, a, b in stays],
        "samplenum int, DESYNPUF_ID string, CLM_ID string, CLM_ADMSN_DT date, NCH_BENE_DSCHRG_DT date, SEGMENT int,"
        " AT_PHYSN_NPI string, OP_PHYSN_NPI string, OT_PHYSN_NPI string, PRVDR_NUM string, CLM_DRG_CD string",
    )
    got = {r["EncounterID"]: r for r in claims.classify_ip(ip, visits, ws).collect()}
    assert {c: r["EncType"] for c, r in got.items()} == {"long": "IS", "short": "IP", "edge": "IS", "after": "IP", "before": "IP"}
    one = got["long"]
    assert (one["Facility_Code"], one["DRG"], one["DRG_Type"], one["Discharge_Disposition"], one["Discharge_Status"], one["Admitting_Source"]) == (
        None, "123", "2", "U", "UN", "UN",
    )


def test_statistics_add_up(driver):
    for row in QUERIES["descriptive_stats"](driver.spark, SF).collect():
        assert len(row) == 40
        assert row.PatIDs == row.Pats_Under18 + row.Pats_18to64 + row.Pats_65plus
        assert row.PatIDs == sum(row[f"Pats_Sex{s}"] for s in stats.SEXES) == sum(row[f"Pats_Race{r}"] for r in stats.RACES)
        assert row.EncounterIDs == sum(row[f"EncounterIDs_{t}"] for t in stats.ENC_TYPES) == row.N_Obs_Encounter


def test_patients_without_events_count_as_zero(spark):
    patients = spark.createDataFrame([(1, "a"), (1, "b")], "samplenum int, PatID string")
    events = spark.createDataFrame([(1, "a"), (1, "a"), (1, "x")], "samplenum int, PatID string")
    assert rows_of(stats.events_per_patient(patients, events, "n")) == [(1, "a", 2), (1, "b", 0)]


def test_workspace_uses_the_shared_folder_and_cleans_up(spark):
    assert shared_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    with Workspace(spark) as w:
        df = w.keep(spark.range(5), "x")
        assert df.count() == 5
        path = w.path
    import os

    assert not os.path.exists(path)


def test_numbered_sources_are_written_in_one_pass(spark, ws, tmp_path):
    from claimloom.catalog.queries import _write_numbered
    from claimloom.sources.readers import read_subsamples

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(1, "a", 1), (1, "a", 1), (2, None, 3), (3, "x", 4), (4, "y", None)]
    df = spark.createDataFrame(rows, "PatID long, Race string, samplenum int")
    _write_numbered(df.mapInArrow(counted, df.schema), "demographic", str(tmp_path))
    assert seen.value == len(rows)
    assert rows_of(read_subsamples(spark, str(tmp_path), "demographic", [1, 2, 3])) == sorted(rows[:3], key=repr)


def test_raw_claims_are_maxima_of_codes_and_lines_are_not_sorted_for_them(spark, ws, tmp_path):
    lines = [(o, (o * 7919 + n * 31 + v * 97) % 20_000, (o * 13 + n + v) % 60, n) for o in range(300) for n in range(1, 9) for v in range(1 + o % 3)]
    lines += [(5, None, 3, 1), (6, 8, None, 2), (None, 1, 1, 1), (7, 1, 1, None), (8, 97, 4, 1), (8, 89, 4, 1), (8, 53, 4, 1)]
    orders = [(o, o * 3, f"{o % 5 + 1}-X") for o in [*range(301), 4]] + [(None, 1, None)]
    line_schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"
    spark.createDataFrame(lines, line_schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    driver, plans = Driver(spark, str(tmp_path), ws), []
    keep = ws.keep
    ws.keep = lambda df, name: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or keep(df, name)
    got = driver.claims
    ws.keep = keep
    columns = [f"{k}_{n}" for k in ("dx", "px") for n in range(1, 8)]
    maxima = [
        f"max(case when l_linenumber = {n} then {code} end) as {k}_{n}" for k, code in (("dx", DX_CODE), ("px", PX_CODE)) for n in range(1, 8)
    ]
    driver.table("lineitem").createOrReplaceTempView("raw_lines")
    driver.table("orders").createOrReplaceTempView("raw_orders")
    want = spark.sql(
        f"select o_orderkey as k, {', '.join(columns)} from raw_orders left join "
        f"(select l_orderkey, {', '.join(maxima)} from raw_lines group by l_orderkey) on o_orderkey = l_orderkey"
    )
    assert rows_of(got.select("k", *columns)) == rows_of(want)
    assert dict(got.dtypes)["dx_1"] == "string"
    assert "SortAggregate" not in plans[0]


def test_lines_and_headers_are_sorted_by_claim_id_first(spark):
    keys = "samplenum int, feed string, PatID string, EncounterID string"
    lines = spark.createDataFrame([(1, "OP", "P1", "C1", "A1"), (2, "OP", "P1", "C1", "A2"), (1, "OP", "P1", None, "A3")], f"{keys}, code string")
    headers = spark.createDataFrame([(1, "OP", "P1", "C1", "AV"), (2, "IP", "P1", "C1", "IP")], f"{keys}, EncType string")
    joined = claims.attach_header(lines, headers, ("EncType",), small_bytes=-1)
    assert joined.columns == ["samplenum", "feed", "EncounterID", "PatID", "code", "EncType"]
    assert rows_of(joined) == [(1, "OP", "C1", "P1", "A1", "AV")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = claims.attach_header(lines, headers, ("EncType",), small_bytes=-1)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [EncounterID#" in plan


def test_only_claims_on_a_list_are_written_as_flags_and_classify_all(spark, ws, driver):
    feeds = {k.upper(): v for k, v in driver.claim_feeds().items()}
    kept, keep = {}, ws.keep
    ws.keep = lambda df, name: kept.setdefault(name, keep(df, name))
    done = claims.process_claims(feeds, driver.master(), driver.code_lists(), ws)
    ws.keep = keep
    every = claims.flag_claims(done.lines)
    assert 0 < kept["claim-flags"].count() < every.count()
    assert kept["claim-flags"].where("not (ind_ed or ind_home or ind_is)").isEmpty()
    visits = claims.classify_op(feeds["OP"], every).unionByName(claims.classify_car(feeds["CAR"], every))
    assert rows_of(kept["visits"]) == rows_of(visits)
    assert {r[0] for r in visits.select("EncType").distinct().collect()} >= {"OA", "AV"}


def test_computed_sources_are_not_computed_for_their_keys(driver, ws, shuffled, monkeypatch):
    from claimloom.operators import joins

    spec, diagnosis = TABLES["diagnosis"], driver.diagnosis()
    crosswalks = combine.build_crosswalks({n: driver.source(n) for n in ("demographic", "encounter", "provider")}, ws)
    read = combine.assemble(ws.keep(diagnosis, "diagnosis"), spec, crosswalks, ordered=False)

    def refuse(*args, **options):
        raise AssertionError("sampled")

    monkeypatch.setattr(joins, "hot_keys", refuse)
    assert rows_of(combine.assemble(diagnosis, spec, crosswalks, ordered=False)) == rows_of(read)


def test_combined_tables_are_exported_one_by_one_in_order(spark, driver, ws, tmp_path, monkeypatch):
    from claimloom.operators.ordering import check_written_order

    tables = combine.combine_frames({n: driver.source(n) for n in TABLES}, ws, ordered=False)
    want = content(tables)
    written, export = [], combine.export_all
    monkeypatch.setattr(combine, "export_all", lambda one, *a: written.append(list(one)) or export(one, *a))
    out = dict(zip(tables, combine.export_combined(tables, str(tmp_path / "out"), "parquet", ws)))
    assert written == [[n] for n in tables]
    check_written_order(spark, out, {n: TABLES[n].order for n in tables})
    assert rows_of(content({n: spark.read.parquet(p) for n, p in out.items()})) == rows_of(want)
    # Nothing of the way there stays in the workspace.
    folder = tmp_path / ws.path.rsplit("/", 1)[1]
    assert not [p for p in folder.rglob("*") if "rekeyed-" in p.name]
    with pytest.raises(ValueError, match="unsupported format"):
        combine.export_combined(tables, str(tmp_path / "other"), "xls", ws)


@pytest.mark.parametrize("name", ["combine_json", "translate_then_combine"])
def test_text_inputs_of_queries_are_compressed(spark, name, tmp_path, monkeypatch):
    import claimloom.catalog.queries as catalog

    written, write = [], catalog.sinks.write_numbered

    def watched(df, table, fmt, folder, *args, **options):
        paths = write(df, table, fmt, folder, *args, **options)
        written.extend(p.name for path in paths for p in tmp_path.glob(f"{path.removeprefix(str(tmp_path)).lstrip('/')}/part-*"))
        return paths

    monkeypatch.setattr(catalog.sinks, "write_numbered", watched)
    monkeypatch.setattr("claimloom.workspace.shared_root", lambda spark: str(tmp_path))
    assert QUERIES[name](spark, SF).count() > 0
    assert written and all(p.endswith(".gz") for p in written)


@pytest.mark.parametrize("name", ["combine_csv", "translate_gap_then_combine"])
def test_tables_are_measured_one_by_one(spark, name, monkeypatch):
    import claimloom.catalog.queries as catalog

    kept, keep = [], Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: kept.append(name) or keep(self, df, name))
    assert catalog.QUERIES[name](spark, SF).count() >= 9
    assert [k for k in kept if k.startswith("measured-")] == [f"measured-{n}" for n in (*SOURCED_TABLES, "provider", "facility")]


def test_translated_tables_are_written_one_after_the_other(spark, driver, ws, tmp_path, monkeypatch):
    import threading

    from claimloom.sources import sinks

    raw, lists = str(tmp_path / "raw"), str(tmp_path / "lists")
    for name, df in {**{f"bene_{y}": df for y, df in driver.bene_years().items()}, "pde": driver.pde(), **driver.claim_feeds()}.items():
        sinks.write_numbered(df, name, "parquet", raw)
    for name in translate.LOOKUP_FILES:
        sinks.write_table(getattr(driver.lookups(), name), f"{lists}/{name}.parquet", "parquet")
    threads, write = [], translate.write_numbered
    monkeypatch.setattr(translate, "write_numbered", lambda *a, **o: threads.append(threading.current_thread()) or write(*a, **o))
    translate.translate_to_files(spark, raw, lists, str(tmp_path / "out"))
    assert threads == [threading.current_thread()] * len(TABLES)
