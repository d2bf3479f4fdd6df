import pytest
from pyspark.sql import functions as F

from claimloom.operators import ids


def numbered(spark, ws, pairs, kind="string", **how):
    df = spark.createDataFrame(pairs, f"PatID {kind}, samplenum int")
    cw = ids.build_crosswalk(df, "PatID", ws, **how)
    return cw, [tuple(r) for r in cw.frame.orderBy("samplenum", "orig_PatID").collect()]


def test_same_id_in_two_subsamples_gets_two_ids(spark, ws):
    _, got = numbered(spark, ws, [("ABC", 1), ("ABC", 2), ("ABC", 2)])
    assert got == [("ABC", 1, 1), ("ABC", 2, 2)]


def test_missing_ids_leave_no_gap(spark, ws):
    cw, got = numbered(spark, ws, [(None, 1), ("B", 1), ("A", 1), (None, 2), ("A", 2)])
    assert got == [("A", 1, 1), ("B", 1, 2), ("A", 2, 3)]
    assert cw.rows == 3


def test_empty_source(spark, ws):
    cw, got = numbered(spark, ws, [])
    assert got == [] and cw.rows == 0
    cw, got = numbered(spark, ws, [(None, 1)], restart=True)
    assert got == []


def test_numbers_restart_in_each_subsample(spark, ws):
    _, got = numbered(spark, ws, [("A", 1), ("B", 1), ("A", 3), ("C", 3)], restart=True)
    assert got == [("A", 1, 1), ("B", 1, 2), ("A", 3, 1), ("C", 3, 2)]


@pytest.mark.parametrize("restart", [False, True])
def test_equals_row_number_when_one_subsample_holds_most_ids(spark, ws, restart):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5003).alias("PatID"), F.when(F.col("id") % 3 > 0, 2).otherwise(F.col("id") % 5).cast("int").alias("samplenum")
    )
    got = ids.build_crosswalk(df, "PatID", ws, restart=restart).frame
    part = "PARTITION BY samplenum" if restart else ""
    got.createOrReplaceTempView("got_ids")
    wrong = spark.sql(f"SELECT * FROM (SELECT *, row_number() OVER ({part} ORDER BY samplenum, orig_PatID) AS want FROM got_ids) WHERE want <> PatID")
    assert wrong.count() == 0 and got.count() == 5000


def test_no_single_partition_step(spark, ws):
    df = spark.range(100).select(F.col("id").alias("PatID"), F.lit(1).alias("samplenum"))
    plan = ids.build_crosswalk(df, "PatID", ws).frame._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_large_ids(spark, ws):
    _, got = numbered(spark, ws, [(2**53, 1), (2**62, 1)], kind="long")
    assert [g[2] for g in got] == [1, 2]


def test_number_rows_with_ties_and_nulls(spark, ws):
    df = spark.createDataFrame([(2,), (None,), (1,), (1,)], "a int")
    got = ids.number_rows(df, ["a"], "pos", ws).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(1, 1), (1, 2), (2, 3), (None, 4)]


def test_collisions(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1), (None, 2)], "PatID string, samplenum int")
    assert [tuple(r) for r in ids.id_collisions(df, "PatID").collect()] == [("A", 2)]


def test_rekey_keeps_column_order(spark, ws):
    cw, _ = numbered(spark, ws, [("A", 1)])
    df = spark.createDataFrame([("x", "A", 1), ("y", "Z", 1), ("z", None, 1)], "v string, PatID string, samplenum int")
    assert [tuple(r) for r in cw.apply(df, "inner").collect()] == [("x", 1, 1)]
    left = cw.apply(df, "left")
    assert left.columns == df.columns
    assert sorted((tuple(r) for r in left.collect())) == [("x", 1, 1), ("y", None, 1), ("z", None, 1)]
