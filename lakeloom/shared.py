"""Written tables in the cluster's shared folder.

Where a plan must be fixed once (row numbering, a frontier, a table that is about to be
overwritten) the rows are written to the shared folder and read back.  Unlike executor
storage this survives lost executors, and the reader still prunes columns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lakeloom-")
    return _local_dirs[app]


def hadoop_path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system and path object of a location."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/lakeloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    retain(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def retain(path: str) -> None:
    """Leave the removal of a written table to the block of scratch tables around, if any."""
    if (written := _written.get()) is not None:
        written.append(path)


@contextmanager
def session_settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the block; the caller's come back at its end."""
    old = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables materialized in the block at its end, once its result is stored.
    After an error they stay: one may be the only whole copy of a table being replaced.
    Gives the paths in the order of writing; what is taken from the list stays."""
    written: list[str] = []
    outer = _written.set(written)
    try:
        yield written
    finally:
        _written.reset(outer)
    for path in written:
        fs, where = hadoop_path(spark, path)
        fs.delete(where, True)
