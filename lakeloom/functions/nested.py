"""Flattening of arrays and structs.

The schema alone decides the plan, so each pass is a projection (structs) or a generator
(arrays) inside one stage.  Sibling arrays multiply; list the columns to flatten with
``flatten_by_settings`` where that is not wanted.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from lakeloom.functions import named
from lakeloom.functions.names import require_distinct


def flatten_once(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One level: an array gives a row per element (NULL and empty arrays keep their row),
    a struct gives one column per field called ``parent_field``; others stay as they are."""
    wanted = set(columns)
    unknown = wanted - set(df.columns)
    if unknown:
        raise ValueError(f"No such columns to flatten: {sorted(unknown)}.")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    fields = []
    for name, kind in kinds.items():
        if name in wanted and isinstance(kind, StructType):
            fields += [(f"{name}_{f}", named(name).getField(f)) for f in kind.fieldNames()]
        else:
            fields.append((name, named(name)))
    require_distinct([name for name, _ in fields])
    flat = df.select(*[column.alias(name) for name, column in fields])

    # Spark takes one generator per projection, hence one projection per array.
    for array in (n for n, k in kinds.items() if n in wanted and isinstance(k, ArrayType)):
        flat = flat.select(
            *[
                F.explode_outer(named(n)).alias(n) if n == array else named(n)
                for n in flat.columns
            ]
        )
    return flat


def _nested_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, StructType))]


def flatten_all(df: DataFrame) -> DataFrame:
    """Flatten until neither arrays nor structs are left."""
    while nested := _nested_columns(df):
        df = flatten_once(df, nested)
    return df


def flatten_by_settings(df: DataFrame, settings: str | Iterable[Mapping[str, Any]]) -> DataFrame:
    """Flatten only the columns of ``{depth, column}`` settings, lowest depth first."""
    if isinstance(settings, str):
        settings = json.loads(settings)
    levels: dict[int, list[str]] = {}
    for setting in settings:
        levels.setdefault(int(setting["depth"]), []).append(setting["column"])
    for depth in sorted(levels):
        df = flatten_once(df, levels[depth])
    return df


def flatten(
    df: DataFrame, mode: str, settings: str | Iterable[Mapping[str, Any]] = ()
) -> DataFrame:
    match mode.strip().lower():
        case "recursive":
            return flatten_all(df)
        case "column":
            return flatten_by_settings(df, settings)
    raise ValueError(f"Flatten mode must be 'recursive' or 'column', not {mode!r}.")
