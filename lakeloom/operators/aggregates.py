"""Plain grouped aggregates; Spark combines them map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import named


def grouped_sum(df: DataFrame, keys: Sequence[str], column: str, total: str) -> DataFrame:
    return df.groupBy(*map(named, keys)).agg(F.sum(named(column)).alias(total))
