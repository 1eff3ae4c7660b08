"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_scopes = threading.local()


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one of this machine only where none is named, as in tests."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="reportloom-"))


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, path: str | None = None, outlives: bool = False) -> DataFrame:
    """Writes the frame and reads it back: later passes read columns, and losing an executor recomputes nothing.

    A table that outlives the innermost scope belongs to the one around it, if there is one.
    """
    path = path or fresh_path(df.sparkSession, "table")
    for paths in getattr(_scopes, "open", [])[: -1 if outlives else None][-1:]:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes what ``materialise`` writes in a block, and in this thread, when the block ends, after a failure too.

    Frames that read it must have been used up by then.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            remove(spark, path)


@contextmanager
def scratch_table(df: DataFrame) -> Iterator[DataFrame]:
    """``materialise`` for as long as a block lasts."""
    with scratch_scope(df.sparkSession):
        yield materialise(df)
