"""Metadata-declared typed projections."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.constants import DATETIME_FORMAT, LOCAL_ZONE
from lakeloom.functions import named
from lakeloom.roles import TypedColumn


def _timestamp(text: Column, strict: bool) -> Column:
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(text, DATETIME_FORMAT if strict else F.lit(DATETIME_FORMAT))


def _plain(column: Column, strict: bool) -> Column:
    return _timestamp(column, strict)


def _in_local_zone(column: Column, strict: bool) -> Column:
    return F.from_utc_timestamp(_timestamp(column, strict), LOCAL_ZONE)


def _iso(column: Column, strict: bool) -> Column:
    return _timestamp(F.translate(F.left(column, F.lit(19)), "T", " "), strict)


SHORTHANDS = {"datetime1": _plain, "datetime2": _in_local_zone, "datetime3": _iso}


def shorthand(text: str | None, strict: bool = False) -> Column:
    """``#datetime1(col)`` parses date-time text, ``#datetime2`` also moves it from UTC to
    local time, ``#datetime3`` accepts ISO text with a ``T`` and a fraction."""
    found = re.fullmatch(r"#(\w+)\(([^()]+)\)", (text or "").strip())
    if not found:
        raise ValueError(f"{text!r} is not a shorthand such as #datetime1(order_dt).")
    name, column = found[1], found[2].strip()
    if name not in SHORTHANDS:
        raise ValueError(f"Unknown shorthand {name!r}; known: {sorted(SHORTHANDS)}.")
    return SHORTHANDS[name](named(column), strict)


def typed_column(column: TypedColumn, strict: bool = False) -> Column:
    if column.expression.startswith("#"):
        value = shorthand(column.expression, strict)
    elif column.expression.startswith("@"):
        value = F.expr(column.expression[1:])
    else:
        value = named(column.expression)
    cast = value.cast if strict else value.try_cast
    return cast(column.type).alias(column.name)


def select_typed(df: DataFrame, columns: Iterable[TypedColumn], strict: bool = False) -> DataFrame:
    """Project and cast.  Values that do not convert become NULL, or fail when ``strict``."""
    return df.select(*[typed_column(c, strict) for c in columns])
