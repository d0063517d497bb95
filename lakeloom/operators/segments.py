"""Windows over one key that are spread over many tasks.

A window keeps all rows of a key in one task.  Here the rows of a key with many of them are cut
into segments of its order column, by approximate quantiles; windows run within segments, and
what they need of other segments is a row per key and segment: its first and last row and
sums.  Keys with few rows are one segment, as an ordinary window has them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from lakeloom.functions import named
from lakeloom.shared import materialize

#: Rows that a segment has about, and the most segments of a key: a key's quantiles are sketched
#: map-side, so their number must be fixed.
SEGMENT_ROWS, MOST_SEGMENTS = 1_000_000, 4096
SEGMENT = "__segment"


def _same_keys(keys: Sequence[str], mine: str) -> Column:
    """Null-safe, as windows put NULL keys together."""
    return reduce(and_, [named(k).eqNullSafe(named(f"{mine}{i}")) for i, k in enumerate(keys)])


def segmented(
    df: DataFrame, keys: Sequence[str], order: str, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """``df`` with the number of each row's segment, growing with ``order``.  Rows of a key that
    agree in ``order`` share a segment, NULLs the first.  Only dates, times and numbers are cut;
    another ``order`` leaves every key one segment."""
    kinds = (DateType, TimestampType, TimestampNTZType, NumericType)
    if not isinstance(df.schema[order].dataType, kinds):
        return df.withColumn(SEGMENT, F.lit(0))
    counts = df.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > segment_rows)
    hot = hot.select(*[named(k).alias(f"__h{i}") for i, k in enumerate(keys)], "__n")
    hot = materialize(hot, "hot-keys")
    most = hot.agg(F.max("__n")).first()[0]
    if most is None:
        return df.withColumn(SEGMENT, F.lit(0))
    n = min(MOST_SEGMENTS, -(-most // segment_rows))
    # Sketches, not rows, meet in a key's task; a few more quantiles than a smaller key needs.
    rows = df.join(hot.drop("__n"), _same_keys(keys, "__h"), "left_semi")
    shares = F.lit([i / n for i in range(1, n)])
    cuts = rows.groupBy(*map(named, keys)).agg(
        F.array_distinct(F.percentile_approx(named(order), shares, 10 * n)).alias("__cuts")
    )
    cuts = cuts.select(*[named(k).alias(f"__c{i}") for i, k in enumerate(keys)], "__cuts")
    cuts = materialize(cuts, "cuts")
    below = F.size(F.filter("__cuts", lambda c: c < named(order)))
    return df.join(cuts, _same_keys(keys, "__c"), "left").select(
        *map(named, df.columns), F.when(F.col("__cuts").isNull(), 0).otherwise(below).alias(SEGMENT)
    )


def change_groups(
    df: DataFrame, keys: Sequence[str], order: str, value: str, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Add ``group_id``: how often ``value`` has changed up to a row of its key.  A change from
    or to NULL is none.  ``order`` should tell the rows of a key apart.

    Each segment counts its own changes; the changes before it, and whether its first row is
    one, come from the edges of the segments of its key."""
    cut = segmented(df, keys, order, segment_rows)
    part = [*map(named, keys), F.col(SEGMENT)]
    ordered = Window.partitionBy(*part).orderBy(named(order))
    before = F.lag(named(value)).over(ordered)
    cut = cut.withColumn("__changed", F.when(before != named(value), 1).otherwise(0))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("__inside", F.sum("__changed").over(running))
    cut = materialize(cut.drop("__changed"), "segments")
    row = F.struct(named(order).alias("o"), named(value).alias("v"))
    edges = cut.groupBy(*part).agg(
        F.min(row)["v"].alias("__first"), F.max(row)["v"].alias("__last"), F.max("__inside").alias("__sum")
    )
    # A row per key and segment: at most MOST_SEGMENTS to a task.
    along = Window.partitionBy(*map(named, keys)).orderBy(SEGMENT)
    starts = F.when(F.lag("__last").over(along) != F.col("__first"), 1).otherwise(0)
    earlier = F.coalesce(
        F.sum("__sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    so_far = F.sum("__starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = edges.withColumn("__starts", starts).withColumn("__offset", earlier + so_far)
    edges = edges.where("__offset > 0").select(
        *[named(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(SEGMENT).alias("__s"), "__offset"
    )
    same = _same_keys(keys, "__k") & (F.col(SEGMENT) == F.col("__s"))
    group = F.col("__inside") + F.coalesce("__offset", F.lit(0))
    return cut.join(edges, same, "left").select(
        *map(named, df.columns), group.cast("bigint").alias("group_id")
    )
