"""Landed files to bronze tables: flat, clean names, everything text."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructType

from lakeloom.functions.names import clean_names, stringify
from lakeloom.functions.nested import flatten
from lakeloom.functions.stamps import stamp_key
from lakeloom.operators.marks import newest
from lakeloom.roles import is_true
from lakeloom.sources.files import (
    folder_state,
    read_json_files,
    read_parquet_files,
    stamp_folders,
    table_exists,
)
from lakeloom.sources.records import read_record, write_record
from lakeloom.sources.sinks import overwrite, replace_since


def bronze_rows(
    df: DataFrame, mode: str = "recursive", settings: str | Iterable[Mapping[str, Any]] = ()
) -> DataFrame:
    return stringify(clean_names(flatten(df, mode, settings)))


def _stamp_state(spark: SparkSession, source: str, partition: str, mark: str | None, how: Any) -> list[str] | None:
    """The stamp ``mark``, or the newest one, with a digest of its landed files and of how they
    are loaded; None if it has no folder of its own."""
    folders = stamp_folders(spark, source, partition)
    key = stamp_key(mark) if mark else (stamp_key(folders[-1].stamp) if folders else None)
    same = [f for f in folders if stamp_key(f.stamp) == key]
    if len(same) != 1 or (mark and same[0].stamp != str(mark)):
        return None
    text = json.dumps([how, folder_state(spark, same[0].path)], default=str)
    return [same[0].stamp, hashlib.sha256(text.encode()).hexdigest()]


def _is_loaded(spark: SparkSession, source: str, target: str, partition: str, mark: str, how: Any) -> bool:
    """Whether the mark's stamp lies in the target as it lies in the source: none of its files
    has come, gone or changed since a run that ended well has loaded it in the same way."""
    held = read_record(spark, target).get("loaded")
    if held is None or all(f.stamp != str(mark) for f in stamp_folders(spark, target, partition)):
        return False
    return held == _stamp_state(spark, source, partition, mark, how)


def _load(
    spark: SparkSession,
    source: str,
    target: str,
    partition: str,
    mark: str | None,
    inclusive: bool,
    how: Any,
    read: Callable[[bool], DataFrame],
    make: Callable[[DataFrame], DataFrame],
) -> str | None:
    """Write, and take the new mark from the same pass.  Empty input keeps the old one.  An
    inclusive mark's stamp that is loaded already and unchanged is not loaded again."""
    if mark is not None and inclusive and _is_loaded(spark, source, target, partition, mark, how):
        inclusive = False
    state = _stamp_state(spark, source, partition, None, how)
    landed, seen = read(inclusive), Observation()
    # No landed row gets lost on the way, so the stamps of these are those of the rows made of
    # them, which may be many more.
    early = isinstance(landed.schema[partition].dataType, StringType)
    if early:
        landed = landed.observe(seen, newest(landed, partition).alias("newest"))
    df = make(landed)
    if not early:
        df = df.observe(seen, newest(df, partition).alias("newest"))
    # Landed files lie by stamp already: a scan task writes few stamps, unshuffled.
    if mark is None:
        overwrite(df, target, [partition], rebalance=False)
    else:
        if inclusive:
            # The stamp that it tells of is being replaced.
            write_record(spark, target, loaded=None)
        replace_since(df, target, partition, mark, inclusive=inclusive)
    found = seen.get.get("newest")
    if found is not None:
        write_record(spark, target, loaded=state if state and state[0] == found else None)
    return found or mark


def update_from_json(
    spark: SparkSession,
    source: str,
    target: str,
    partition: str = "partition",
    mark: str | None = None,
    flatten_mode: str = "recursive",
    flatten_settings: str | Iterable[Mapping[str, Any]] = (),
    multi_line: bool | str = False,
    full_refresh: bool | str = False,
    schema: StructType | str | None = None,
    inclusive: bool = True,
) -> str | None:
    """Load JSON documents from ``mark`` on, or all of them on a full refresh, for a new
    target, or without a mark.  Where a stamp is complete once loaded, ``inclusive=False``
    saves loading the last one again."""
    if is_true(full_refresh) or not table_exists(spark, target):
        mark = None
    if not isinstance(flatten_settings, str):
        flatten_settings = list(flatten_settings)

    def read(inclusive: bool) -> DataFrame:
        return read_json_files(
            spark, source, partition, mark, is_true(multi_line), schema, inclusive=inclusive
        )

    def make(landed: DataFrame) -> DataFrame:
        return bronze_rows(landed, flatten_mode, flatten_settings)

    kind = schema.jsonValue() if isinstance(schema, StructType) else schema
    how = ["json", flatten_mode, flatten_settings, is_true(multi_line), kind]
    return _load(spark, source, target, partition, mark, inclusive, how, read, make)


def update_from_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    partition: str = "partition",
    mark: str | None = None,
    full_refresh: bool | str = False,
    inclusive: bool = True,
) -> str | None:
    """Load parquet files likewise; nested columns become JSON text."""
    if is_true(full_refresh) or not table_exists(spark, target):
        mark = None

    def read(inclusive: bool) -> DataFrame:
        return read_parquet_files(spark, source, partition, mark, inclusive=inclusive)

    def make(landed: DataFrame) -> DataFrame:
        return stringify(clean_names(landed))

    return _load(spark, source, target, partition, mark, inclusive, ["parquet"], read, make)
