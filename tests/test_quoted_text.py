import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from claimloom.sources import quoted_text, readers, sinks

NOTES = [None, "", "a", "x\ny", '"', '"\n"', "\n\n", "\r\nz", 'a,b"c\\"', "\t", "é\n", " ", "end\r", "\n" * 30, '""\n,', "long " * 60 + "\n"]


@pytest.fixture
def small_ranges(spark, monkeypatch):
    """Cut every file, into ranges of a few hundred bytes."""
    monkeypatch.setattr(quoted_text, "SPLIT_BYTES", 0)
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def noted(spark, n, seed):
    rnd = random.Random(seed)
    return spark.createDataFrame([(i, rnd.choice(NOTES), rnd.choice(NOTES)) for i in range(n)], "id int, note string, other string")


@pytest.mark.parametrize("fmt", ["csv", "txt"])
@pytest.mark.parametrize("seed", [1, 2])
def test_cut_files_give_the_same_rows(spark, tmp_path, small_ranges, fmt, seed):
    df = noted(spark, 120, seed).repartition(2)
    path = str(tmp_path / f"t.{fmt}")
    sinks.write_table(df, path, fmt)
    lines = quoted_text._ranged_lines(spark, [path])
    assert lines.select("_file", "_start").distinct().count() > 10
    assert rows_of(sinks.read_table(spark, path, fmt, df.schema)) == rows_of(df)


def test_a_value_longer_than_several_ranges(spark, tmp_path, small_ranges):
    df = spark.createDataFrame([(1, "a"), (2, "line\n" * 400), (3, "b\nc"), (4, 'q"' * 300 + "\n")], "id int, note string").coalesce(1)
    sinks.write_table(df, str(tmp_path / "t.csv"), "csv")
    assert rows_of(sinks.read_table(spark, str(tmp_path / "t.csv"), "csv", df.schema)) == rows_of(df)


def test_carriage_returns_blank_lines_and_no_last_line_feed(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_bytes(b'id,note\r\n1,a\r\n\r\n2,"x\r\ny"\r\n3,""\r\n4,')
    back = sinks.read_table(spark, str(tmp_path / "t.csv"), "csv", spark.createDataFrame([], "id int, note string").schema)
    assert rows_of(back) == [(1, "a"), (2, "x\r\ny"), (3, ""), (4, None)]


@pytest.mark.parametrize(
    ("text", "message"),
    [('id,note\n1,"a\n', "a quoted value has no end"), ("id,note\n1,a,b\n", "MALFORMED|Malformed|malformed"), ("id,note\nx,a\n", "not a value of type int in column id")],
)
def test_bad_files_are_errors(spark, tmp_path, small_ranges, text, message):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        sinks.read_table(spark, str(tmp_path / "t.csv"), "csv", spark.createDataFrame([], "id int, note string").schema).collect()


def test_another_header_is_an_error(spark, tmp_path, small_ranges):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,note\n1,a\n")
    (folder / "b.csv").write_text("note,id\n1,2\n")
    with pytest.raises(Exception, match="another header in"):
        sinks.read_table(spark, str(folder), "csv", spark.createDataFrame([], "id int, note string").schema).collect()


def test_header_only(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_text("id,note\n")
    assert sinks.read_table(spark, str(tmp_path / "t.csv"), "csv", spark.createDataFrame([], "id int, note string").schema).count() == 0


def test_tagged_reading_of_cut_files(spark, tmp_path, small_ranges):
    df = spark.range(40).select(F.concat(F.lit("P\n"), "id").alias("PatID"), F.lit("x").alias("Source"), (F.col("id") % 2 + 1).cast("int").alias("samplenum"))
    sinks.write_numbered(df, "death", "csv", str(tmp_path))
    back = readers.read_subsamples(spark, str(tmp_path), "death", [1, 2], "csv")
    assert rows_of(back.select("PatID", "Source", "samplenum")) == rows_of(df)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_one_subsample_opens_its_files_only(spark, tmp_path, fmt):
    df = spark.range(40).select(F.col("id").cast("string").alias("PatID"), (F.col("id") % 4 + 1).cast("int").alias("samplenum"))
    sinks.write_numbered(df, "death", fmt, str(tmp_path))
    one = readers.read_subsamples(spark, str(tmp_path), "death", [1, 2, 3, 4], fmt).where("samplenum = 3")
    run = one._jdf.queryExecution()
    files = len(list((tmp_path / f"death_3.{fmt}").glob("part-*")))
    assert run.toRdd().count() == 10
    assert run.executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == files
