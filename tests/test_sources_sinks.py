import datetime as dt

import pytest
from conftest import rows_of

from claimloom.schema import TABLES
from claimloom.sources import readers, sinks


def death_rows(spark, n=3):
    return spark.createDataFrame(
        [(f"P{i}", dt.date(2010, 1, 1) if i % 2 else None, "D", "", None) for i in range(n)],
        "PatID string, DeathDt date, DtImpute string, Source string, Confidence string",
    )


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_round_trip_keeps_nulls_dates_and_empty_strings(spark, tmp_path, fmt):
    df = death_rows(spark, 250)
    sinks.write_table(df, str(tmp_path / f"death.{fmt}"), fmt)
    back = sinks.read_table(spark, str(tmp_path / f"death.{fmt}"), fmt, df.schema)
    assert rows_of(back) == rows_of(df)


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported format: xls"):
        sinks.export_all({"death": death_rows(spark)}, str(tmp_path / "o"), "xls")
    assert not (tmp_path / "o").exists()


def test_export_all_makes_the_folder(spark, tmp_path):
    paths = sinks.export_all({"death": death_rows(spark).coalesce(1)}, str(tmp_path / "new" / "out"), "csv")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["death.csv"]
    text = next((tmp_path / "new" / "out" / "death.csv").glob("part-*.csv")).read_text().splitlines()
    assert text[0] == "PatID,DeathDt,DtImpute,Source,Confidence"
    assert text[1] == 'P0,,D,"",'


def test_parquet_is_zstd(spark, tmp_path):
    sinks.write_table(death_rows(spark), str(tmp_path / "d.parquet"), "parquet")
    assert list((tmp_path / "d.parquet").glob("*.zstd.parquet"))


def test_tagged_scan_and_discovery(spark, tmp_path):
    for n in (1, 2, 10):
        death_rows(spark, n).write.parquet(str(tmp_path / f"death_{n}.parquet"))
    df = readers.read_subsamples(spark, str(tmp_path), "death", [1, 2, 10])
    assert {r["samplenum"]: r["count"] for r in df.groupBy("samplenum").count().collect()} == {1: 1, 2: 2, 10: 10}
    assert dict(df.dtypes)["DeathDt"] == "date"
    assert rows_of(readers.found_pairs(spark, str(tmp_path))) == [("death", 1), ("death", 10), ("death", 2)]


def test_files_with_other_types_and_columns(spark, tmp_path):
    spark.sql("SELECT 1 AS PatID, 'x' AS Source").write.parquet(str(tmp_path / "death_1.parquet"))
    spark.sql("SELECT 2L AS patid, 'y' AS Source, 'E' AS Confidence").write.parquet(str(tmp_path / "death_2.parquet"))
    df = readers.read_subsamples(spark, str(tmp_path), "death", [1, 2])
    assert dict(df.dtypes)["PatID"] == "bigint"
    assert rows_of(df.select("PatID", "Source", "Confidence", "samplenum")) == [(1, "x", None, 1), (2, "y", "E", 2)]


def test_plain_files_are_found_too(spark, tmp_path):
    (tmp_path / "death_3.csv").write_text("PatID,DeathDt,DtImpute,Source,Confidence\n5,2009-01-02,D,L,E\n")
    assert rows_of(readers.found_pairs(spark, str(tmp_path), "csv")) == [("death", 3)]
    row = readers.read_subsamples(spark, str(tmp_path), "death", [3], "csv").first()
    assert tuple(row) == ("5", dt.date(2009, 1, 2), "D", "L", "E", 3)
    from pyspark.sql import types as T

    assert readers.read_subsamples(spark, str(tmp_path), "death", [3], "csv", id_type=T.LongType()).first()["PatID"] == 5


def test_only_the_folder_itself_is_searched(spark, tmp_path):
    for name in ("backup/death_9.csv", "bene_2008_1.csv", "x/old_1.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("a\n")
    assert rows_of(readers.found_pairs(spark, str(tmp_path), "csv")) == [("bene_2008", 1)]


def test_text_ids_and_short_or_reordered_headers(spark, tmp_path):
    (tmp_path / "enrollment_1.csv").write_text("PatID,Enr_Start,Enr_End,MedCov,DrugCov,Chart\nABC,2009-01-01,2009-02-01,Y,N,N\n")
    (tmp_path / "enrollment_2.csv").write_text("PlanType,chart,PatID,Enr_Start,Enr_End,MedCov,DrugCov,Extra\nHMO,N,007,2009-01-01,,Y,N,?\n")
    df = readers.read_subsamples(spark, str(tmp_path), "enrollment", [1, 2], "csv")
    assert df.columns == [*TABLES["enrollment"].columns, "samplenum"]
    got = rows_of(df.select("PatID", "Enr_End", "Chart", "PlanType", "samplenum"))
    assert got == [("007", None, "N", "HMO", 2), ("ABC", dt.date(2009, 2, 1), "N", None, 1)]


@pytest.mark.parametrize("fmt", ["csv", "txt", "json"])
def test_a_bad_value_names_file_and_column(spark, tmp_path, fmt):
    line = {"csv": "PatID,DeathDt\nA,2009-13-02\n", "txt": "PatID\tDeathDt\nA\t2009-13-02\n", "json": '{"PatID": "A", "DeathDt": "2009-13-02"}\n'}
    (tmp_path / f"death_1.{fmt}").write_text(line[fmt])
    with pytest.raises(Exception, match=rf"column DeathDt of .*death_1\.{fmt}: 2009-13-02"):
        readers.read_subsamples(spark, str(tmp_path), "death", [1], fmt).collect()


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_a_broken_row_is_an_error(spark, tmp_path, fmt):
    (tmp_path / f"death_1.{fmt}").write_text({"csv": "PatID,DeathDt\nA,2009-01-02,x,y\n", "json": '{"PatID": \n'}[fmt])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_subsamples(spark, str(tmp_path), "death", [1], fmt).collect()


def test_an_id_never_becomes_a_floating_point_number(spark, tmp_path):
    spark.sql("SELECT 1L AS PatID").write.parquet(str(tmp_path / "death_1.parquet"))
    spark.sql("SELECT 2.5D AS PatID").write.parquet(str(tmp_path / "death_2.parquet"))
    with pytest.raises(ValueError, match="PatID"):
        readers.read_subsamples(spark, str(tmp_path), "death", [1, 2])


def test_plans_grow_with_layouts_not_with_files(spark, tmp_path):
    for n in range(1, 9):
        spark.sql(f"SELECT {n} AS PatID{', 1 AS Source' if n == 8 else ''}").write.parquet(str(tmp_path / f"death_{n}.parquet"))
    df = readers.read_subsamples(spark, str(tmp_path), "death", range(1, 9))
    assert df.count() == 8 and df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_wider_types():
    from pyspark.sql import types as T

    assert readers.wider_type(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2)
    assert readers.wider_type(T.LongType(), T.DecimalType(5, 3)) == T.DecimalType(22, 3)
    assert readers.wider_type(T.DecimalType(10, 2), T.DoubleType()) == T.DoubleType()
    assert readers.wider_type(T.DecimalType(38, 0), T.DecimalType(38, 30)) == T.StringType()


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_any_text_comes_back(spark, tmp_path, fmt):
    texts = [" a", "b ", " ", "", None, "\\N", "x\ny", "a\r\nb", "\t", "\tt", '"', '""', 'a"b,c', "\\", "a\\\"", "#x", "é", ",", "null", "'"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "n int, a string, b string")
    sinks.write_table(df, str(tmp_path / f"x.{fmt}"), fmt)
    assert rows_of(sinks.read_table(spark, str(tmp_path / f"x.{fmt}"), fmt, df.schema)) == rows_of(df)


def test_a_long_range_is_not_built(spark):
    found = spark.createDataFrame([("a", 1)], "table_name string, samplenum int")
    missing, wanted = readers.audit_completeness(found, ["a"], 1, 2_000_000_000)
    assert len(wanted) == 2_000_000_000 and missing.limit(2).count() == 2


def test_zero_rows_still_have_all_columns(spark, tmp_path):
    spec = TABLES["encounter"]
    spark.createDataFrame([], spec.struct(samplenum=False)).write.parquet(str(tmp_path / "encounter_1.parquet"))
    df = readers.read_subsamples(spark, str(tmp_path), "encounter", [1])
    assert df.columns == [*spec.columns, "samplenum"] and df.count() == 0
    assert readers.read_subsamples(spark, str(tmp_path), "encounter", []).columns == [*spec.columns, "samplenum"]


def test_every_missing_file_is_named(spark):
    found = spark.createDataFrame([("a", 1), ("b", 1), ("a", 3)], "table_name string, samplenum int")
    missing, numbers = readers.audit_completeness(found, ["a", "b"])
    assert rows_of(missing) == [("a", 2), ("b", 2), ("b", 3)] and list(numbers) == [1, 2, 3]
    missing, numbers = readers.audit_completeness(found, ["a", "b"], 1, 1)
    assert rows_of(missing) == [] and list(numbers) == [1]
    with pytest.raises(ValueError, match="no subsample files"):
        readers.audit_completeness(found.where("samplenum > 9"), ["a"])


def test_parse_selection():
    assert readers.parse_selection("5-8") == [5, 6, 7, 8]
    assert readers.parse_selection("1 3  9") == [1, 3, 9]


def test_export_selection(spark, tmp_path):
    from pyspark.sql import functions as F

    df = death_rows(spark, 9).withColumn("samplenum", (F.substring("PatID", 2, 1).cast("int") % 3) + 1)
    paths = sinks.export_selection({"death": df, "diagnosis": df}, "1 3", ["death", "diagnosis"], ["json", "txt"], str(tmp_path))
    assert sorted(p[len(str(tmp_path)) + 1 :] for p in paths) == [
        f"{folder}_{fmt}/{name}_{n}.{fmt}"
        for folder, name in (("diagnosis", "diagnosis"), ("subsamples", "death"))
        for fmt in ("json", "txt")
        for n in (1, 3)
    ]
    assert sorted(p.name for p in (tmp_path / "subsamples_txt").iterdir()) == ["death_1.txt", "death_3.txt"]
    back = readers.read_subsamples(spark, str(tmp_path / "subsamples_txt"), "death", [1, 3], "txt")
    assert rows_of(back.select(*df.columns)) == rows_of(df.where("samplenum <> 2"))
    with pytest.raises(FileExistsError):
        sinks.export_selection({"death": df}, [1], ["death"], ["txt"], str(tmp_path))
    with pytest.raises(ValueError):
        sinks.export_selection({"death": df}, [1], ["nope"], ["csv"], str(tmp_path))


def test_export_stats(spark, tmp_path):
    stats = spark.createDataFrame([(1, 5)], "SubSample int, PatIDs long")
    assert len(sinks.export_stats(stats, str(tmp_path))) == 3
    assert (tmp_path / "descriptive_stats_json" / "descriptive_stats.json").exists()
    big = spark.createDataFrame([(1, 1234567)], "SubSample int, PatIDs long")
    path = sinks.export_stats(big, str(tmp_path / "t"), ["csv"], thousands=True)[0]
    assert tuple(spark.read.csv(path, header=True).first()) == ("1", "1,234,567")


def test_append_harmonised(spark):
    base = spark.createDataFrame([(1, "x", 2.0)], "ID int, Name string, v float")
    nxt = spark.createDataFrame([(2**40, "n", 5)], "id long, New string, V long")
    out = readers.append_harmonised(base, nxt)
    assert out.columns == ["ID", "Name", "v", "New"]
    assert dict(out.dtypes) == {"ID": "bigint", "Name": "string", "v": "double", "New": "string"}
    assert rows_of(out) == sorted([(1, "x", 2.0, None), (2**40, None, 5.0, "n")], key=repr)


def test_json_names_in_any_case(spark, tmp_path):
    (tmp_path / "death_1.json").write_text('{"patid":"A1","DEATHDT":"2009-01-02","dtimpute":"D","extra":[1]}\n\n{"PatID":7,"Source":null}\n')
    df = readers.read_subsamples(spark, str(tmp_path), "death", [1], "json")
    assert rows_of(df) == [("7", None, None, None, None, 1), ("A1", dt.date(2009, 1, 2), "D", None, None, 1)]
    (tmp_path / "death_2.json").write_text('{"patid":"A1","PatID":"A2"}\n')
    with pytest.raises(Exception, match="(?i)duplicate"):
        readers.read_subsamples(spark, str(tmp_path), "death", [2], "json").collect()


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_a_file_without_the_id_of_its_rows_is_an_error(spark, tmp_path, fmt):
    for n, name in ((1, "PATID"), (2, "Person")):
        sinks.write_table(spark.createDataFrame([("A", "D")], f"{name} string, DtImpute string"), str(tmp_path / f"death_{n}.{fmt}"), fmt)
    assert readers.read_subsamples(spark, str(tmp_path), "death", [1], fmt).count() == 1
    with pytest.raises(ValueError, match=rf"no column PatID in .*death_2\.{fmt}"):
        readers.read_subsamples(spark, str(tmp_path), "death", [1, 2], fmt)


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_subsamples_without_rows_get_files(spark, tmp_path, fmt):
    from pyspark.sql import functions as F

    df = death_rows(spark, 4).withColumn("samplenum", F.lit(2))
    paths = sinks.export_selection({"death": df}, [1, 2, 3], ["death"], [fmt], str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == [f"death_{n}.{fmt}" for n in (1, 2, 3)]
    back = readers.read_subsamples(spark, str(tmp_path / f"subsamples_{fmt}"), "death", [1, 2, 3], fmt)
    assert back.groupBy("samplenum").count().collect() == [(2, 4)] and back.columns == [*TABLES["death"].columns, "samplenum"]
    with pytest.raises(ValueError, match="other subsamples"):
        sinks.write_numbered(df, "death", fmt, str(tmp_path / "x"), numbers=[1])


def test_a_set_is_whole_or_refused(spark, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path / "set")
    df = death_rows(spark, 4).withColumn("samplenum", F.lit(1))
    (tmp_path / "set" / "death_2.csv").mkdir(parents=True)
    with pytest.raises(FileExistsError):
        sinks.write_numbered(df.unionByName(df.withColumn("samplenum", F.lit(2))), "death", "csv", folder)
    # Nothing has been moved, and the folder tells that a run was interrupted.
    assert not (tmp_path / "set" / "death_1.csv").exists()
    with pytest.raises(ValueError, match="not finished: .*_writing_death_csv"):
        sinks.committed_set(spark, folder, "csv")
    assert sinks.committed_set(spark, folder, "parquet") is None
    for rows in ({("death", 1): 4}, {("death", 1): 4, ("death", 3): 0}):
        sinks.commit_set(spark, folder, "json", rows)
        assert sinks.committed_set(spark, folder, "json") == rows


def test_files_that_the_manifest_lacks_are_not_combined(spark, ws, tmp_path):
    from claimloom.plans import combine

    for name, spec in TABLES.items():
        for n in (1, 2):
            empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in spec.columns))
            empty.write.parquet(str(tmp_path / f"{name}_{n}.parquet"))
    sinks.commit_set(spark, str(tmp_path), "parquet", {(t, n): 0 for t in TABLES for n in (1, 2) if (t, n) != ("death", 2)})
    with pytest.raises(ValueError, match=r"not in the manifest of .*: death_2\.parquet"):
        combine.combine(spark, str(tmp_path), ws)
    done = combine.combine(spark, str(tmp_path), ws, numbers=[1])
    assert sorted(done) == sorted(TABLES) and all(df.count() == 0 for df in done.values())


def test_json_is_parsed_once_into_a_written_table(spark, ws, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, 1), ("c", "", 2)], "PatID string, Race string, samplenum int")
    sinks.write_numbered(df, "demographic", "json", str(tmp_path / "in"))
    read = readers.read_subsamples(spark, str(tmp_path / "in"), "demographic", [1, 2], "json", ws=ws)
    plain = readers.read_subsamples(spark, str(tmp_path / "in"), "demographic", [1, 2], "json")
    assert read.columns == plain.columns and rows_of(read) == rows_of(plain)
    assert "Parquet" in read._jdf.queryExecution().executedPlan().toString()
    sinks.write_table(df.drop("PatID", "samplenum"), str(tmp_path / "in" / "demographic_3.json"), "json")
    with pytest.raises(ValueError, match="no column PatID in demographic_3.json"):
        readers.read_subsamples(spark, str(tmp_path / "in"), "demographic", [1, 2, 3], "json", ws=ws)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.mark.parametrize("how", ["keep", "write_table", "write_numbered"])
def test_written_tables_leave_no_shuffle_files(spark, ws, tmp_path, how):
    import time

    df = spark.range(2000).selectExpr("id % 3 as samplenum", "id % 50 as k").groupBy("samplenum", "k").count()
    before = shuffle_files(spark)
    if how == "keep":
        ws.keep(df, "counts")
    elif how == "write_table":
        sinks.write_table(df.orderBy("k"), str(tmp_path / "t.csv"), "csv")
    else:
        sinks.write_numbered(df, "counts", "parquet", str(tmp_path / "n"), ["k"])
    for _ in range(20):  # they are deleted in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("fmt", ["csv", "txt", "json"])
def test_compressed_text_is_read_as_plain_text_is(spark, ws, tmp_path, fmt, monkeypatch):
    from claimloom.sources import quoted_text

    df = death_rows(spark, 40).selectExpr("*", "cast(1 + length(PatID) % 2 as int) as samplenum")
    df = df.withColumn("Source", df.Source.substr(1, 0)).replace("D", 'x\n"y"', ["DtImpute"])
    folder = str(tmp_path / "in")
    sinks.write_numbered(df, "death", fmt, folder, numbers=[1, 2, 3], compression="gzip")
    parts = [p.name for p in (tmp_path / "in").rglob("part-*")]
    assert parts and all(p.endswith(f".{fmt if fmt == 'json' else 'csv'}.gz") for p in parts)
    # However large, a compressed file is not cut.
    monkeypatch.setattr(quoted_text, "SPLIT_BYTES", 1)
    back = readers.read_subsamples(spark, folder, "death", [1, 2, 3], fmt, ws=ws)
    assert rows_of(back.select(*df.columns)) == rows_of(df)
    assert "_before" not in back._jdf.queryExecution().toString()
