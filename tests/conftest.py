import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark, tmp_path):
    from claimloom.workspace import Workspace

    with Workspace(spark, str(tmp_path)) as w:
        yield w


@pytest.fixture
def shuffled(monkeypatch):
    """Make every join take the shuffle path and every frequent key count as hot."""
    from claimloom.operators import joins

    monkeypatch.setattr(joins, "SMALL_BYTES", -1)
    monkeypatch.setattr(joins, "SAMPLE", 1.0)
    monkeypatch.setattr(joins, "SALTS", 4)
    monkeypatch.setattr(joins, "MIN_SAMPLED", 3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
