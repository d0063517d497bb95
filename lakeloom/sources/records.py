"""A small record beside a table: what a plan must know of it without reading it.

The record is one JSON file in the table's folder, under a name that readers of the table skip.
It holds the table's schema, the greatest surrogate key and the keys of its buckets.  What
replaces the whole folder removes it too, so it never outlives what it describes; a missing or
torn record only costs a look at the table itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
)

from lakeloom.shared import hadoop_path

NAME = "_record.json"


def read_record(spark: SparkSession, path: str) -> dict[str, Any]:
    """The record of the table at ``path``; empty if there is none or it is torn."""
    fs, where = hadoop_path(spark, f"{path}/{NAME}")
    if not fs.exists(where):
        return {}
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return {}
    finally:
        stream.close()


def write_record(spark: SparkSession, path: str, **changes: Any) -> None:
    """Change fields of the record; None removes one."""
    record = read_record(spark, path) | changes
    record = {k: v for k, v in record.items() if v is not None}
    fs, where = hadoop_path(spark, f"{path}/{NAME}")
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    found = read_record(spark, path).get("schema")
    return None if found is None else StructType.fromJson(found)


@contextmanager
def rewriting(spark: SparkSession, path: str, *fields: str) -> Iterator[dict[str, Any]]:
    """Around a change of the table: ``fields`` are not to be believed until the block has
    ended, and then are what it has put into the yielded dict.  If it fails they stay away."""
    write_record(spark, path, **dict.fromkeys(fields))
    found: dict[str, Any] = {}
    yield found
    write_record(spark, path, **{f: found.get(f) for f in fields})


_WHOLE = [ByteType, ShortType, IntegerType, LongType]


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds the values of both and that files of either can be read as, or None."""
    if a == b:
        return a
    kinds = type(a), type(b)
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda x: _WHOLE.index(type(x)))
    if all(k in (FloatType, DoubleType) for k in kinds):
        return DoubleType()
    if DoubleType in kinds and any(k in _WHOLE[:3] for k in kinds):
        return DoubleType()
    if all(k is DecimalType for k in kinds):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(precision, scale) if precision <= 38 else None
    return None


def merged_schema(held: StructType, new: StructType) -> StructType:
    """The columns of both, those held first, each as wide as both need."""
    merged = StructType()
    fresh = {f.name: f.dataType for f in new.fields}
    for f in held.fields:
        kind = wider(f.dataType, fresh.get(f.name, f.dataType))
        if kind is None:
            raise TypeError(
                f"Column {f.name} is {f.dataType.simpleString()} in the table"
                f" and {fresh[f.name].simpleString()} in the new rows."
            )
        merged.add(f.name, kind)
    for f in new.fields:
        if f.name not in held.names:
            merged.add(f.name, f.dataType)
    return merged
