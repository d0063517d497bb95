"""Dense surrogate keys.

``row_number()`` over an unpartitioned window would send the whole table through one task.
Here rows are range-partitioned by the key and sorted within partitions; the number of a row
is its place in its partition plus the size of all earlier partitions.  The placed rows are
written once, because the sizes and the numbers must come from the same placement even when
executors are lost.  Only one row per partition is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import named
from lakeloom.shared import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def max_surrogate(df: DataFrame, surrogate_key: str) -> DataFrame:
    """One row: the greatest surrogate key, 0 when there is none."""
    return df.agg(
        F.coalesce(F.max(named(surrogate_key)).cast("bigint"), F.lit(0)).alias("max_surrogate")
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], column: str, start: int | Column = 0
) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in ``order_by`` order, NULLs last, without
    gaps.  ``order_by`` must identify a row, or equal rows may change numbers between runs."""
    order = [named(c).asc_nulls_last() for c in order_by]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    part = F.shiftright("__place", _ROW_BITS)
    placed = materialize(placed, "numbered").withColumn("__part", part)

    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset")
    )
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    base = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    return placed.join(F.broadcast(offsets), "__part").select(
        *[named(c) for c in df.columns if c != column],
        (base + F.col("__offset") + row + 1).cast("bigint").alias(column),
    )
