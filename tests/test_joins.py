import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from claimloom.operators import joins


@pytest.fixture
def sides(spark):
    """A third of the left rows have one key, a third have none; all are exact copies."""
    left = spark.createDataFrame(
        [(7, 1, "x")] * 30 + [(None, 1, "y")] * 30 + [(i, i % 2 + 1, "z") for i in range(30)], "id int, samplenum int, v string"
    )
    right = spark.createDataFrame(
        [(i, s, f"r{i}{s}") for i in range(0, 30, 2) for s in (1, 2)] + [(7, 1, "a"), (7, 1, "b"), (None, 1, "n")],
        "id long, samplenum int, w string",
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffle_path_gives_the_same_rows(sides, shuffled, how):
    left, right = sides
    on = ["id", "samplenum"]
    got = joins.skew_join(left, right, on, how)
    want = left.join(right, on, how).select(*got.columns)
    assert rows_of(got) == rows_of(want)


def test_hot_and_missing_keys_are_found(sides, shuffled):
    hot = joins.hot_keys(sides[0], ["id", "samplenum"], share=1 / 4, sample=1.0)
    assert len(hot.hashes) == 1 and hot.missing
    assert not joins.hot_keys(sides[0].where("v = 'z'"), ["id", "samplenum"], share=1 / 4, sample=1.0).hashes


@pytest.mark.parametrize("key, how", [(1, "inner"), (1, "left"), (None, "left"), (None, "left_anti")])
def test_rows_of_a_hot_or_missing_key_are_spread(spark, shuffled, key, how):
    left = spark.range(0, 4000, 1, 8).select(F.lit(key).cast("int").alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, w string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = joins.skew_join(left, right, ["k"], how)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(sizes) == 4000 and len(sizes) > 1


def test_small_side_is_broadcast_and_large_is_not(sides, monkeypatch):
    left, right = sides
    plan = joins.skew_join(left, right, ["id", "samplenum"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
    monkeypatch.setattr(joins, "SMALL_BYTES", 100)
    plan = joins.skew_join(left, right, ["id", "samplenum"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a int, b string")
    assert joins.measured_bytes(df) == 2 * 2 * 16 + 3
    assert joins.measured_bytes(df.where("a > 5")) == 0


def test_membership(sides):
    left, right = sides
    assert {r["id"] for r in joins.only_in(left, right, ["id"]).collect()} == {7, *range(0, 30, 2)}
    assert {r["id"] for r in joins.not_in(left, right, ["id"]).collect()} == {None, *[i for i in range(1, 30, 2) if i != 7]}


def test_match_lookup_keeps_unmatched(spark):
    bene = spark.createDataFrame([("1 ", "23"), ("9", "9")], "s string, c string")
    zips = spark.createDataFrame([("123", "00001")], "ssacd string, ZIP string")
    key = F.concat(F.trim("s"), F.trim("c"))
    assert rows_of(joins.match_lookup(bene, zips, key, "ssacd")) == [("1 ", "23", "00001"), ("9", "9", None)]


def test_a_side_that_has_to_be_computed_is_not_measured(spark):
    from claimloom.operators import rows

    left = spark.createDataFrame([(i % 7, i) for i in range(50)], "k long, v int").distinct()
    right = spark.range(100).groupBy((F.col("id") % 5).alias("k")).count()
    spark.sparkContext.setJobGroup("planning", "no job may start")
    try:
        got = joins.skew_join(left, right, ["k"])
        members = joins.only_in(left, right, ["k"])
        repeated = rows.duplicate_keys(left, ["k"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got.count() == sum(i % 7 < 5 for i in range(50)) == members.count() and repeated.count() == 50
