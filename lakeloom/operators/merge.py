"""Table mutations as pure functions ``(target, updates) -> new target``.

Plain parquet tables have no MERGE.  An update-all / insert-all merge equals the target
without the updated keys plus the updates: one anti join, in which Spark broadcasts the update
keys when they are small (the target is then not shuffled at all) and otherwise splits hot
keys by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import named
from lakeloom.operators.dedup import distinct_keys, require_unique
from lakeloom.operators.filters import drop_null_keys
from lakeloom.shared import materialize


def like_target(updates: DataFrame, target: DataFrame) -> DataFrame:
    """The updates in the target's column order and types; both must have the same columns."""
    if set(updates.columns) != set(target.columns):
        odd = sorted(set(updates.columns) ^ set(target.columns))
        raise ValueError(f"Target and updates differ in columns {odd}.")
    return updates.select(
        *[named(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def delete_matching(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without rows whose key occurs in ``doomed``; NULL keys stay.  Keys are made
    distinct before they are shuffled."""
    return target.join(distinct_keys(doomed, keys), list(keys), "left_anti").select(
        *map(named, target.columns)
    )


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], unique: bool = False
) -> DataFrame:
    """Replace the rows of the updated keys and insert the others.  Updates with a NULL key
    are dropped.  Say ``unique`` where keys are known to be, to skip the check."""
    updates = drop_null_keys(like_target(updates, target), keys)
    if not unique:
        require_unique(updates, keys)
    others = target.join(updates.select(*map(named, keys)), list(keys), "left_anti")
    return others.select(*map(named, target.columns)).unionByName(updates)


def replace_batches(target: DataFrame, updates: DataFrame, batch_keys: Sequence[str]) -> DataFrame:
    """Delete every target row whose batch occurs in the updates, then add the updates."""
    updates = drop_null_keys(like_target(updates, target), batch_keys)
    return delete_matching(target, updates, batch_keys).unionByName(updates)


def in_partitions(
    target: DataFrame, updates: DataFrame, partition_by: Sequence[str], touched: bool = True
) -> DataFrame:
    """The target's rows in partitions that ``updates`` has rows in, or in the others.  NULL is
    a partition like any other.  The updates' partitions are written first: Spark then knows how
    few they are, and does not shuffle the target by them, a task for each."""
    if not partition_by:
        raise ValueError("Partition columns are required.")
    kinds = {c: target.schema[c].dataType for c in partition_by}
    found = distinct_keys(updates, partition_by).select(
        *[named(c).cast(kinds[c]).alias(f"__{i}") for i, c in enumerate(partition_by)]
    )
    found = materialize(found, "partitions")
    same = reduce(and_, [named(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(partition_by)])
    return target.join(found, same, "left_semi" if touched else "left_anti")


def merge_in_partitions(
    target: DataFrame,
    updates: DataFrame,
    partition_by: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``merge`` to the partitions the updates touch; other rows neither match nor change."""
    others = in_partitions(target, updates, partition_by, touched=False)
    return others.unionByName(merge(in_partitions(target, updates, partition_by), updates))
