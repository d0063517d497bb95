"""High-water marks: how far a source has been loaded."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from lakeloom.functions import named
from lakeloom.functions.stamps import stamp_order
from lakeloom.operators.merge import upsert


def max_mark(df: DataFrame, column: str) -> DataFrame:
    """One row: the greatest value of ``column``, of text in the order of stamps; NULL for an
    empty input."""
    return df.agg(newest(df, column).alias(column))


def newest(df: DataFrame, column: str) -> Column:
    """The aggregate behind ``max_mark``."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.max(F.struct(stamp_order(named(column)).alias("key"), named(column).alias("m")))["m"]
    return F.max(named(column))


def read_mark(df: DataFrame, column: str | None) -> Any:
    return max_mark(df, column).first()[0] if column else None


def upsert_marks(
    marks: DataFrame, updates: DataFrame, mark: str, key: str = "task_id"
) -> DataFrame:
    """Store new marks by task.  A run over empty input has no mark; it keeps the old one."""
    known = marks.select(key, named(mark).alias("__old"))
    kept = (
        updates.join(known, key, "left")
        .withColumn(mark, F.coalesce(named(mark), named("__old")))
        .select(*marks.columns)
    )
    return upsert(marks, kept, [key])
