import datetime as dt

import pytest
from conftest import rows_of

from claimloom.operators import rows
from claimloom.schema import TABLES


def test_missing_sort_keys_are_all_named(spark):
    with pytest.raises(ValueError, match="Enr_Start, Chart"):
        rows.check_sort_keys(spark.createDataFrame([(1,)], "PatID int"), ["PatID", "Enr_Start", "Chart"])


def test_sort_contract_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(2, None, "b"), (1, dt.date(2009, 1, 1), "z"), (None, None, "a"), (1, dt.date(2008, 1, 1), "y"), (1, dt.date(2008, 1, 1), "x")],
        "PatID int, RxDate date, Rx string",
    )
    got = [(r["PatID"], r["Rx"]) for r in rows.sort_contract(df, TABLES["dispensing"]).collect()]
    assert got == [(1, "x"), (1, "y"), (1, "z"), (2, "b"), (None, "a")]


@pytest.mark.parametrize("path", ["small", "shuffled"])
def test_duplicates_and_counts_include_missing_keys(spark, path, request):
    if path == "shuffled":
        request.getfixturevalue("shuffled")
    df = spark.createDataFrame([("a", 1)] * 30 + [("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    dup = rows.duplicate_keys(df, ["k"])
    assert dup.columns == ["k", "v", "counter"]
    assert rows_of(dup) == sorted([("a", 1, 31)] * 30 + [("a", 2, 31), (None, 4, 2), (None, 5, 2)], key=repr)
    assert rows.with_group_count(df, ["k"]).count() == 34


def test_dedupe_and_picks(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "y"), ("b", 5, None)], "k string, n int, v string")
    assert rows.dedupe(df).count() == 3
    assert rows_of(rows.dedupe(df, ["k"])) == [("a", 1, "y"), ("b", 5, None)]
    assert rows_of(rows.last_in_group(df, ["k"], ["n"])) == [("a", 2, "x"), ("b", 5, None)]
    assert rows_of(rows.min_max_by(df, ["k"], lo=("min", "n"), hi=("max", "n"))) == [("a", 1, 2), ("b", 5, 5)]


def test_pivot_sum_is_null_only_when_nothing_is_known(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 1, None)], "k string, t int, x int")
    assert rows_of(rows.pivot_sum(df, ["k"], "t", [1, 2], {"x": "x"})) == [("a", 5, 0), ("b", None, None)]


def test_max_length_profile(spark):
    df = spark.createDataFrame([("ab  ", None, 1), ("a", None, 2)], "s string, e string, n int")
    assert rows_of(rows.max_length_profile(df)) == [("e", 1), ("s", 2)]


def test_small_operators(spark):
    df = spark.createDataFrame([(1, dt.date(2008, 1, 1), dt.date(2008, 1, 1), "x")], "SEGMENT int, s date, e date, icd9_dgns_cd_1 string")
    assert rows.valid_intervals(df, "s", "e").count() == 1
    assert rows.valid_intervals(df, "s", "e", strict=True).count() == 0
    assert rows.first_segment(df).count() == 1
    assert rows.study_window(df, "s").count() == 1 and rows.study_window(df, "s", "2009-01-01").count() == 0
    assert rows.keep_prefixed(df, ["ICD9_"]) == ["icd9_dgns_cd_1"]
    assert rows.rename(df, {"s": "start"}).columns[1] == "start"
    assert rows.with_constants(df, {"a": "1", "b": None}).first()[-2:] == ("1", None)
    assert rows.row_count(df) == 1
