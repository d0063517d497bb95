"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from lakeloom.functions import named
from lakeloom.functions.stamps import stamp_key, stamp_order


def since(df: DataFrame, column: str | None, mark: Any, inclusive: bool = True) -> DataFrame:
    """Rows at or after a high-water mark (or only after it); all rows without one.  The mark
    takes the column's type, so the filter prunes partitions and reaches the parquet scan.
    Text is compared in the order of stamps; marks other than plain digits reach the scan."""
    if not column or mark is None or mark == "":
        return df
    kind, value = df.schema[column].dataType, named(column)
    lowest = F.lit(mark).cast(kind)
    if isinstance(kind, StringType):
        value, lowest = stamp_order(value), F.lit(stamp_key(mark))
    return df.filter(value >= lowest if inclusive else value > lowest)


def require_flags(df: DataFrame, flags: Sequence[str]) -> None:
    missing = [c for c in flags if c not in df.columns]
    if missing:
        raise ValueError(f"Filter columns are missing: {missing}.")
    wrong = {c: df.schema[c].dataType.simpleString() for c in flags}
    wrong = {c: t for c, t in wrong.items() if t != BooleanType().simpleString()}
    if wrong:
        raise TypeError(f"Filter columns must be boolean, not {wrong}.")


def keep_flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows where every named boolean column is true; NULL drops the row."""
    require_flags(df, flags)
    return df.filter(reduce(and_, map(named, flags))) if flags else df


def filter_metrics(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row: rows before and after ``keep_flagged``, counted in a single pass."""
    require_flags(df, flags)
    kept = F.count_if(reduce(and_, map(named, flags), F.lit(True)))
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        kept.alias("rows_kept"),
        (F.count(F.lit(1)) - kept).alias("filtered_rows"),
    )


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows in which any key column is NULL."""
    return df.filter(reduce(and_, [named(k).isNotNull() for k in keys])) if keys else df


def latest_snapshot(df: DataFrame, date_key: str) -> DataFrame:
    """Rows of the newest date.  The date is a scalar subquery: one column is read for it,
    nothing is joined, and the result is pushed into the scan."""
    newest = df.agg(F.max(named(date_key))).scalar()
    return df.filter(named(date_key) == newest)
