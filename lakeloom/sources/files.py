"""Scans of landed files and tables."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from typing import Any, NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.functions.stamps import stamp_key
from lakeloom.operators.filters import since
from lakeloom.shared import hadoop_path
from lakeloom.sources.buckets import BUCKET
from lakeloom.sources.records import recorded_schema


class StampFolder(NamedTuple):
    stamp: str
    path: str


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``; a missing one forces a full refresh."""
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    # What starts so is hidden: also what a write that failed has left.
    return any(not n.startswith((".", "_")) for n in names)


def stamp_folders(spark: SparkSession, path: str, partition: str) -> list[StampFolder]:
    """The ``partition=stamp`` folders, oldest stamp first (one per extraction)."""
    fs, where = hadoop_path(spark, path)
    prefix, found = f"{partition}=", []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            # Folder names have special characters escaped; the stamp has not.
            stamp = unquote(name.removeprefix(prefix))
            found.append(StampFolder(stamp, f"{path}/{name}"))
    return sorted(found, key=lambda f: (stamp_key(f.stamp), f.stamp))


def folder_state(spark: SparkSession, path: str) -> list[list[Any]]:
    """Name, length and time of every file below a folder."""
    fs, where = hadoop_path(spark, path)
    found, listed = [], fs.listFiles(where, True)
    while listed.hasNext():
        f = listed.next()
        found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return sorted(found)


def folders_since(
    folders: list[StampFolder], mark: Any, inclusive: bool = True
) -> list[StampFolder]:
    """The folders of the stamps at or after ``mark`` (or only after it)."""
    above = operator.ge if inclusive else operator.gt
    return [f for f in folders if above(stamp_key(f.stamp), stamp_key(mark))]


def _text_stamp(schema: StructType, partition: str) -> StructType:
    """``schema`` with the stamp as text, last: guessed as a number it loses leading zeros."""
    fields = [f for f in schema.fields if f.name != partition]
    return StructType([*fields, StructField(partition, StringType())])


def _scan(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: dict[str, Any],
    schema: StructType | str | None,
    partition: str | None,
    mark: str | None,
    inclusive: bool,
) -> DataFrame:
    """Read the stamp folders from ``mark`` on.  Older ones are neither listed nor read, which
    matters most for JSON, whose schema inference would read the whole landing area."""

    def reader() -> DataFrameReader:
        return spark.read.format(fmt).options(**options).option("basePath", path)

    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    folders = stamp_folders(spark, path, partition) if partition else []
    if not folders:
        if partition and schema is not None:
            return spark.createDataFrame([], _text_stamp(schema, partition))
        return (reader() if schema is None else reader().schema(schema)).load(path)
    wanted = folders_since(folders, mark, inclusive) if mark else folders
    # With nothing new the last folder still tells the schema.
    paths = [f.path for f in wanted or folders[-1:]] if mark else path
    found = schema if schema is not None else reader().load(paths).schema
    df = reader().schema(_text_stamp(found, partition)).load(paths)
    return df if wanted else df.where(F.lit(False))


def read_json_files(
    spark: SparkSession,
    path: str,
    partition: str | None = None,
    mark: str | None = None,
    multi_line: bool = False,
    schema: StructType | str | None = None,
    typed: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """JSON documents with all scalars as strings, their structure inferred from every record.
    ``typed`` infers scalar types too; a ``schema`` saves the inference pass."""
    options = {
        "primitivesAsString": not typed,
        "samplingRatio": 1.0,
        "multiLine": multi_line,
    }
    return _scan(spark, path, "json", options, schema, partition, mark, inclusive)


def read_parquet_files(
    spark: SparkSession,
    path: str,
    partition: str | None = None,
    mark: str | None = None,
    schema: StructType | str | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Parquet files whose schemas may differ; columns a file lacks are NULL."""
    options = {"mergeSchema": True}
    return _scan(spark, path, "parquet", options, schema, partition, mark, inclusive)


def file_schema(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> StructType:
    """All columns that a table's rows have or had: the schema of its record, or, for tables
    that have none, that of all its files, with its partition columns last and as text."""
    schema = recorded_schema(spark, path)
    if schema is None:
        schema = spark.read.format(fmt).option("mergeSchema", True).load(path).schema
        for f in schema.fields:
            if f.name in partition_by:
                f.dataType = StringType()
    return schema


def read_table(
    spark: SparkSession,
    path: str,
    column: str | None = None,
    mark: Any = None,
    fmt: str = "parquet",
    evolved: bool = False,
) -> DataFrame:
    """A table, optionally from a high-water mark on, without its layout column.  Its record
    tells the schema.  For ``evolved`` tables, which were appended to with new columns, but have
    no record, the schemas of all files are merged."""
    return since(laid_out(spark, path, fmt, evolved).drop(BUCKET), column, mark)


def laid_out(
    spark: SparkSession, path: str, fmt: str = "parquet", evolved: bool = False
) -> DataFrame:
    """A table with its layout column."""
    reader = spark.read.format(fmt)
    schema = None if fmt == "delta" else recorded_schema(spark, path)
    if schema is not None:
        reader = reader.schema(schema)
    elif evolved:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def read_stamped(
    spark: SparkSession,
    path: str,
    partition: str | None,
    mark: Any = None,
    fmt: str = "parquet",
    evolved: bool = True,
    inclusive: bool = True,
    text: bool = False,
) -> DataFrame:
    """A table from a mark on (or only after it), by stamp folders where it has them: its
    record tells the schema, and only folders from the mark on are listed and read.  Where a
    table has no record the schemas of all its files are merged.  ``text`` says that the stamp
    is an extraction stamp, not a date or a number."""
    folders = stamp_folders(spark, path, partition) if partition and fmt == "parquet" else []
    if not folders:
        return since(read_table(spark, path, fmt=fmt, evolved=evolved), partition, mark, inclusive)
    schema = recorded_schema(spark, path)
    if schema is None:
        schema = spark.read.format(fmt).option("mergeSchema", True).load(path).schema
    if text:
        schema = _text_stamp(schema, partition)
    reader = spark.read.format(fmt).option("basePath", path).schema(schema)
    if mark is None or mark == "":
        return reader.load(path)
    wanted = folders_since(folders, mark, inclusive)
    df = reader.load([f.path for f in wanted or folders[-1:]])
    return df if wanted else df.where(F.lit(False))
