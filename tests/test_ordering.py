import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators.ordering import check_written_order, range_lines, written_order
from claimloom.schema import TABLES
from claimloom.sources import readers, sinks


def breaks(rows):
    """Places where a row comes after the next one, nulls last."""
    keyed = [tuple((v is None, v if v is not None else 0) for v in r) for r in rows]
    return sum(a > b for a, b in zip(keyed, keyed[1:]))


def written(spark, path, parts, schema="a int, b string", fmt="parquet", **options):
    """Rows in part files as given, one file per list."""
    rows = [(i, *r) for i, part in enumerate(parts) for r in part]
    df = spark.createDataFrame(rows, f"_file int, {schema}").coalesce(1)
    placed = df.rdd.map(lambda r: (r[0], r)).partitionBy(len(parts), lambda k: k).values()
    sinks.write_table(spark.createDataFrame(placed, df.schema).drop("_file"), path, fmt)
    return path


def found(spark, path, keys=("a", "b"), **options):
    r = written_order(spark, path, keys, **options).first()
    return r["n_rows"], r["n_breaks"]


def test_breaks_inside_files_and_between_them(spark, tmp_path):
    path = written(spark, str(tmp_path / "t"), [[(1, "x"), (3, "y")], [(2, "a"), (2, "b"), (2, "a")], [(5, "é")]])
    assert found(spark, path) == (6, 2)
    assert found(spark, path, ("a",)) == (6, 1)


@pytest.mark.parametrize("seed", range(3))
def test_like_a_plain_pass(spark, tmp_path, seed):
    rnd = random.Random(seed)
    values = [None, 1, 2, 3]
    parts = [[(rnd.choice(values), rnd.choice([None, "", "a", "B", "é", "zz"])) for _ in range(rnd.randrange(1, 40))] for _ in range(7)]
    for part in parts[:4]:
        part.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, (r[1] or "").encode()))
    path = written(spark, str(tmp_path / "t"), parts)
    flat = [(a, None if b is None else b.encode()) for part in parts for a, b in part]
    want = sum(x > y for x, y in zip(*[[((a is None, a or 0), (b is None, b or b"")) for a, b in flat][i:] for i in (0, 1)]))
    assert found(spark, path) == (len(flat), want)


def test_ranges_of_one_file_and_small_batches(spark, tmp_path):
    df = spark.range(0, 20000, 1, 1).select(F.when(F.col("id") == 15000, 0).otherwise(F.col("id")).alias("a"))
    df.write.option("parquet.block.size", 8192).parquet(str(tmp_path / "t"))
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": "777", "spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert range_lines(spark, str(tmp_path / "t"), ["a"]).count() > 1
        assert found(spark, str(tmp_path / "t"), ("a",)) == (20000, 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_table_without_rows(spark, tmp_path):
    spark.createDataFrame([], "a int, b string").write.parquet(str(tmp_path / "t"))
    assert found(spark, str(tmp_path / "t")) == (0, 0)


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_every_format(spark, tmp_path, fmt):
    path = written(spark, str(tmp_path / f"t.{fmt}"), [[(1, "x\ny"), (2, "a")], [(1, None), (10, "b")], [(None, "c")]], fmt=fmt)
    schema = spark.createDataFrame([], "a int, b string").schema
    assert found(spark, path, fmt=fmt, schema=schema) == (5, 1)


def test_nothing_is_shuffled_but_the_lines(spark, tmp_path):
    path = written(spark, str(tmp_path / "t"), [[(1, "x")], [(2, "y")]], "a int, b string")
    plan = range_lines(spark, path, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "b#" not in plan.split("ReadSchema")[1]


def test_tables_out_of_order_are_refused(spark, tmp_path):
    spec = TABLES["death"]
    rows = spark.createDataFrame([("P2", "a"), ("P1", "b")], "PatID string, Source string").coalesce(1)
    rows.write.parquet(str(tmp_path / "death.parquet"))
    with pytest.raises(ValueError, match=r"not in order: death \(1 places\)"):
        check_written_order(spark, {"death": str(tmp_path / "death.parquet")}, {"death": spec.sort_keys[:1]})
