"""Where jobs may put intermediate tables: always a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only on a local master without it."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="billflow-")
    spark.conf.set(CHECKPOINT_DIR, local)
    return local


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, kept if executors die."""
    path = fresh_dir(rows.sparkSession, purpose)
    if (made := _passing.get()) is not None:
        made.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table or folder, wherever it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_going(*sessions: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files: they go with the query that wrote them, not with the
    driver's garbage."""
    before = [s.conf.get(SHUFFLES_GO, None) for s in sessions]
    for s in sessions:
        s.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        for s, value in zip(sessions, before):
            if value is None:
                s.conf.unset(SHUFFLES_GO)
            else:
                s.conf.set(SHUFFLES_GO, value)


@contextmanager
def passing(*sessions: SparkSession) -> Iterator[None]:
    """Tables that :func:`written` makes inside are gone at the end, shuffles before: for work whose result is
    stored by then."""
    mark = _passing.set([])
    try:
        with shuffles_going(*sessions):
            yield
    finally:
        for path in _passing.get():
            dropped(sessions[0], path)
        _passing.reset(mark)
