"""Durable tables for results that several later steps read.

A written table cuts lineage and survives the loss of executors, and Spark
knows its size when it plans the joins that read it.
"""

from __future__ import annotations

import atexit
import contextlib
import itertools
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def run_together(steps: Sequence[Callable[[], object]]) -> list:
    """Run steps that start Spark jobs and do not depend on each other at the same time.

    The jobs keep the caller's job group and scheduler pool.
    """
    if not steps:
        return []
    carry = inheritable_thread_target(SparkSession.getActiveSession()) if SparkSession.getActiveSession() else (lambda f: f)
    with ThreadPoolExecutor(max_workers=min(len(steps), 8)) as pool:
        return [f.result() for f in [pool.submit(carry(step)) for step in steps]]


def hadoop_path(spark: SparkSession, path: str):
    """A path of the cluster's file systems, and the file system it is in."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="claimloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    That is ``spark.checkpoint.dir``, or what ``setCheckpointDir`` has set.
    Only a session on one machine without either gets a temporary folder, one
    for the process, which goes with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping_lock = threading.Lock()
#: By session: how many writes are under way, and what the setting was before them.
_dropping: dict[str, tuple[int, str]] = {}


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside deletes its shuffle files when it has been written.

    Otherwise they stay until the driver happens to collect its garbage, and
    the disk holds those of all steps of a run at once.  A frame that is read
    again shuffles again, as it would have done.
    """
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        writes, before = _dropping.get(session, (0, ""))
        before = before if writes else spark.conf.get(_DROP_SHUFFLES, "false")
        _dropping[session] = writes + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            writes, before = _dropping.pop(session)
            if writes > 1:
                _dropping[session] = writes - 1, before
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


class Workspace:
    """A private subfolder of the shared folder for one run's written tables.

    It is deleted by ``close`` or when the interpreter ends; results that
    still read it must have been written or collected by then.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or shared_root(spark)).rstrip('/')}/claimloom-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)
        self._used = False
        self._entries: list[str] = []
        atexit.register(self._close_at_exit)

    def new_path(self, name: str) -> str:
        self._used = True
        return f"{self.path}/{next(self._numbers):03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = self.new_path(name)
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, name: str, buckets: int, columns: Sequence[str]) -> DataFrame:
        """Write ``df`` once in buckets of ``columns``: joins on them with tables of as many buckets need no shuffle.

        Spark takes what it knows of buckets from its catalog.  The returned
        frame has it once it is resolved, so the entry goes at once and no run
        leaves one behind; the files stay until ``close``.
        """
        entry = f"{self.path.rsplit('/', 1)[1]}_{next(self._numbers)}".replace("-", "_")
        self._entries.append(entry)
        df.write.bucketBy(buckets, *columns).option("path", self.new_path(name)).saveAsTable(entry)
        table = self.spark.table(entry)
        table.schema  # resolved here, where the entry is still there
        self._drop_entries()
        return table

    def close(self) -> None:
        """Delete this run's tables and their catalog entries."""
        self._drop_entries()
        if self._used:
            folder, system = hadoop_path(self.spark, self.path)
            system.delete(folder, True)
            self._used = False
        atexit.unregister(self._close_at_exit)

    def _drop_entries(self) -> None:
        # The tables lie at paths of their own, so dropping an entry deletes no file.
        while self._entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entries.pop()}")

    def _close_at_exit(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            self.close()

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
