"""Bronze tables to silver tables: typed, filtered, deduplicated, written four ways."""

from __future__ import annotations

from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lakeloom.constants import WRITE_METHODS
from lakeloom.functions import named
from lakeloom.functions.typed import select_typed
from lakeloom.operators.dedup import latest_per_batch, latest_per_key
from lakeloom.operators.filters import drop_null_keys, keep_flagged
from lakeloom.operators.marks import read_mark
from lakeloom.operators.merge import in_partitions, replace_batches, upsert
from lakeloom.roles import SilverRoles, is_true
from lakeloom.shared import materialize, scratch_tables
from lakeloom.sources.buckets import (
    BUCKET,
    bucket_count,
    buckets_of,
    folder_bytes,
    in_buckets,
    labels,
    with_bucket,
)
from lakeloom.sources.files import laid_out, read_stamped, table_exists
from lakeloom.sources.sinks import (
    append_strict,
    overwrite,
    overwrite_buckets,
    overwrite_partitions,
    replace_buckets,
)


def silver_transform(df: DataFrame, roles: SilverRoles, strict: bool = False) -> DataFrame:
    """Typed projection, flag filter, latest batch, latest row per key, output columns."""
    if not roles.outputs:
        raise ValueError("No column is an output.")
    df = keep_flagged(select_typed(df, roles.columns, strict), roles.filters)
    if roles.batch_keys and roles.order_by:
        df = latest_per_batch(df, roles.batch_keys, roles.order_by)
    if roles.primary_keys:
        df = latest_per_key(df, roles.primary_keys, roles.order_by)
    return df.select(*map(named, roles.outputs))


def default_write_method(roles: SilverRoles) -> str:
    """The method that the declared keys suggest."""
    if roles.batch_keys:
        return "bk_merge"
    return "pk_merge" if roles.primary_keys else "append"


def _merge_keys(roles: SilverRoles, write_method: str) -> tuple[str, ...]:
    return roles.primary_keys if write_method == "pk_merge" else roles.batch_keys


def write_silver(
    df: DataFrame,
    target: str,
    roles: SilverRoles,
    write_method: str,
    partitions_immutable: bool = False,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Write by method.  Merges rewrite the key buckets that the updates touch, or, where a key
    never leaves its partition, the partitions that they touch.  A table without such buckets
    gets them by its first merge, ``buckets`` of them or as many as its size suggests, and one
    that has outgrown its buckets gets twice as many."""
    if write_method not in WRITE_METHODS:
        raise ValueError(f"Write method {write_method!r} is none of {WRITE_METHODS}.")
    if write_method == "overwrite":
        return overwrite(df, target, roles.partition_by, fmt)
    if write_method == "append":
        return append_strict(df, target, roles.partition_by, fmt)

    keys = _merge_keys(roles, write_method)
    if write_method == "pk_merge":
        # silver_transform has left one row per primary key.
        merge = partial(upsert, keys=keys, unique=True)
    else:
        merge = partial(replace_batches, batch_keys=keys)
    if not keys:
        raise ValueError(f"Write method {write_method!r} needs key columns.")

    spark = df.sparkSession
    with scratch_tables(spark):
        # The updates are used up to three times; they are as large as one increment.
        df = drop_null_keys(df, keys)
        n = buckets_of(spark, target, df, keys)
        df = materialize(df if n is None else with_bucket(df, keys, n), "updates")

        def held(rows: DataFrame) -> DataFrame:
            # Folder names lose the type of a partition column; the declared one is restored.
            wanted = [f for f in df.schema.fields if f.name != BUCKET]
            return rows.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in wanted])

        whole = laid_out(spark, target, fmt)
        if roles.partition_by and partitions_immutable:
            merged = merge(in_partitions(held(whole), df, roles.partition_by), df)
            return overwrite_partitions(merged, target, roles.partition_by, fmt)
        size = folder_bytes(spark, target)
        if n is None or bucket_count(size) > max(n, buckets or 0):
            merged = merge(held(whole), df.drop(BUCKET))
            n = buckets or bucket_count(size)
            return overwrite_buckets(
                merged, target, keys, n, roles.partition_by, fmt, reads_target=True
            )
        if touched := labels(df):
            merged = merge(held(in_buckets(whole, touched)), df.drop(BUCKET))
            replace_buckets(merged, target, keys, n, touched, roles.partition_by, fmt)


def update_silver(
    spark: SparkSession,
    source: str,
    target: str,
    roles: SilverRoles,
    write_method: str | None = None,
    partition: str = "partition",
    mark: Any = None,
    partitions_immutable: bool | str = False,
    full_refresh: bool | str = False,
    strict: bool = False,
    fmt: str = "parquet",
    inclusive: bool | None = None,
    buckets: int | None = None,
) -> Any:
    """Update a silver table from the bronze rows at or after ``mark``; returns the new mark.
    A missing target, a missing mark or ``full_refresh`` overwrite the table from all rows.
    Without a write method the keys decide.

    Appends take only stamps after the mark, for the mark's own rows are there already; where
    a stamp is complete once loaded, ``inclusive=False`` does so for the other methods too.
    A table that merges will update is laid out in key buckets from the start."""
    write_method = write_method or default_write_method(roles)
    merged = write_method in ("pk_merge", "bk_merge")
    keys = _merge_keys(roles, write_method) if merged else ()
    immutable = bool(roles.partition_by) and is_true(partitions_immutable)
    if is_true(full_refresh) or mark is None or not table_exists(spark, target):
        mark, write_method = None, "overwrite"
    if inclusive is None:
        inclusive = write_method != "append"
    bronze = read_stamped(spark, source, partition, mark, fmt, inclusive=inclusive, text=True)
    rows = silver_transform(bronze, roles, strict)
    if write_method == "overwrite" and keys and not immutable:
        n = buckets or bucket_count(folder_bytes(spark, source))
        overwrite_buckets(rows, target, keys, n, roles.partition_by, fmt)
    else:
        write_silver(rows, target, roles, write_method, immutable, fmt, buckets)
    newest = read_mark(bronze, partition)
    return mark if newest is None else newest
