"""Silver tables to dimensions."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeloom.constants import OPEN_END
from lakeloom.functions import named
from lakeloom.operators.history import (
    affected_keys,
    apply_snapshot,
    build_history,
    check_attributes,
    clean_members,
    extend_history,
    rebuild_dimension,
    snapshot_updates,
    update_dimension,
)
from lakeloom.operators.keys import max_surrogate
from lakeloom.operators.marks import read_mark
from lakeloom.roles import DimensionRoles, HistoryRoles, is_true
from lakeloom.shared import materialize, scratch_tables
from lakeloom.sources.buckets import (
    BUCKET,
    bucket,
    bucket_count,
    buckets_of,
    folder_bytes,
    in_buckets,
    key_types,
    labels,
    leaf_files,
    remove_unchanged,
    with_bucket,
)
from lakeloom.sources.files import laid_out, read_stamped, read_table, table_exists
from lakeloom.sources.records import read_record, rewriting, write_record
from lakeloom.sources.sinks import (
    overwrite,
    overwrite_buckets,
    overwrite_partitions,
    replace_buckets,
)


def highest_key(spark: SparkSession, path: str, column: str, fmt: str = "parquet") -> int:
    """The greatest surrogate key of a table: from its record, or else by reading the column."""
    known = read_record(spark, path).get("highest")
    if known is None:
        known = max_surrogate(laid_out(spark, path, fmt), column).first()[0]
    return known


def _observed(df: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its greatest surrogate key in the pass that writes it."""
    seen = Observation()
    return df.observe(seen, F.max(named(column)).cast("bigint").alias("highest")), seen


def update_dimension_table(
    spark: SparkSession,
    source: str,
    target: str,
    roles: DimensionRoles,
    partition: str | None = None,
    mark: Any = None,
    full_refresh: bool | str = False,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> Any:
    """Rebuild or update a type-1 dimension; returns the new mark.

    The table lies in buckets of its business keys, and its record holds the highest surrogate
    key: an update reads and rewrites the buckets that its members fall into."""
    rebuild = is_true(full_refresh) or not table_exists(spark, target)
    rows = read_stamped(spark, source, partition, None if rebuild else mark, fmt, evolved=False)
    keys, surrogate = roles.business_keys, roles.surrogate_key
    with scratch_tables(spark):
        n = None if rebuild else buckets_of(spark, target, rows, keys)
        if rebuild:
            made, seen = _observed(rebuild_dimension(rows, roles), surrogate)
            n = buckets or bucket_count(folder_bytes(spark, source))
            overwrite_buckets(made, target, keys, n, fmt=fmt)
            write_record(spark, target, highest=seen.get.get("highest") or 0)
        else:
            held, size = laid_out(spark, target, fmt), folder_bytes(spark, target)
            check_attributes(rows.drop(surrogate), held)
            members = clean_members(rows, roles)
            highest = highest_key(spark, target, surrogate, fmt)
            whole = n is None or bucket_count(size) > max(n, buckets or 0)
            if whole:
                n, touched = buckets or bucket_count(size), []
            members = materialize(with_bucket(members, keys, n), "members")
            if not whole:
                touched = labels(members)
                held = in_buckets(held, touched)
            made = update_dimension(members.drop(BUCKET), held.drop(BUCKET), roles, highest)
            made, seen = _observed(made, surrogate)
            with rewriting(spark, target, "highest") as record:
                if whole:
                    overwrite_buckets(made, target, keys, n, fmt=fmt, reads_target=True)
                elif touched:
                    replace_buckets(made, target, keys, n, touched, fmt=fmt)
                found = seen.get.get("highest") if whole or touched else 0
                record["highest"] = max(highest, found or 0)
    newest = read_mark(rows, partition)
    return mark if newest is None else newest


def _loaded_until(held: DataFrame, roles: HistoryRoles) -> Any:
    """The last day that left a mark in the history: the latest end among its partitions and
    the latest start among the open versions."""
    end, open_end = named(roles.valid_to).cast("date"), F.lit(OPEN_END).cast("date")
    closed = held.select(end.alias("day")).filter(end < open_end).distinct()
    started = held.filter(end == open_end).select(named(roles.valid_from).alias("day"))
    return closed.union(started).agg(F.max("day")).first()[0]


#: The label of versions that have ended.
CLOSED = "closed"


def _laid(df: DataFrame, roles: HistoryRoles, n: int) -> DataFrame:
    """Open versions lie in buckets of their keys, those that ended by day only."""
    is_open = named(roles.valid_to).cast("date") == F.lit(OPEN_END).cast("date")
    return df.withColumn(BUCKET, F.when(is_open, bucket(df, roles.primary_keys, n)).otherwise(CLOSED))


def update_history_table(
    spark: SparkSession,
    source: str,
    target: str,
    roles: HistoryRoles,
    mark: Any = None,
    full_refresh: bool | str = False,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> Any:
    """Build or extend a type-2 dimension; returns the newest date loaded.

    An increment applies the mark's day again, for it may have been corrected, and every day
    after it, as if they had come one by one; repeating it changes nothing.  The table is
    partitioned by the end of validity, open versions also by buckets of their keys.  An
    increment first finds the keys it changes, for which it reads the keys and hashes of open
    versions, and then reads and rewrites the buckets of these keys, the versions closed on the
    mark's day and the partitions of its own days, however long the history is."""
    layout, keys, surrogate = [roles.valid_to, BUCKET], roles.primary_keys, roles.surrogate_key
    with scratch_tables(spark):
        rebuild = is_true(full_refresh) or not table_exists(spark, target)
        held = None if rebuild else laid_out(spark, target, fmt)
        unlaid = not rebuild and "buckets" not in read_record(spark, target)
        if unlaid:
            # A table of another layout, or whose record is lost, is rewritten once.
            n = buckets or bucket_count(folder_bytes(spark, target))
            overwrite(_laid(held, roles, n), target, layout, fmt, reads_target=True)
            write_record(spark, target, buckets=n, bucket_keys=key_types(held, keys))
            held = laid_out(spark, target, fmt)
        if rebuild:
            rows = read_table(spark, source, fmt=fmt)
            n = buckets or bucket_count(folder_bytes(spark, source))
            made, seen = _observed(build_history(rows, roles), surrogate)
            overwrite(_laid(made, roles, n), target, layout, fmt)
            found = seen.get.get("highest") or 0
            write_record(
                spark, target, highest=found, buckets=n, bucket_keys=key_types(rows, keys)
            )
            newest = read_mark(rows, roles.date_key)
        else:
            held = held.withColumn(roles.valid_to, named(roles.valid_to).cast("date"))
            loaded = _loaded_until(held, roles)
            days = [d for d in (loaded, mark) if d is not None and d != ""]
            since_day = max(map(str, days)) if days else None
            rows = read_stamped(spark, source, roles.date_key, since_day, fmt, evolved=False)
            # Used several times below, and small against the history.
            rows = materialize(rows, "days")
            newest = read_mark(rows, roles.date_key)
            if newest is not None:
                _extend(spark, rows, held, target, roles, since_day, fmt)
    return mark if newest is None else newest


def _extend(
    spark: SparkSession,
    rows: DataFrame,
    held: DataFrame,
    target: str,
    roles: HistoryRoles,
    since_day: str,
    fmt: str,
) -> None:
    """Apply the days of ``rows`` to the buckets whose keys they change."""
    keys, surrogate, layout = roles.primary_keys, roles.surrogate_key, [roles.valid_to, BUCKET]
    record = read_record(spark, target)
    n = record.get("buckets")
    if n is None or record.get("bucket_keys") != key_types(rows, keys):
        raise ValueError(f"The history at {target} is laid out for other keys; refresh it.")
    affected = with_bucket(affected_keys(rows, held.drop(BUCKET), roles, since_day), keys, n)
    by_bucket = affected.groupBy(BUCKET).agg(F.max("is_corrected").alias("is_corrected")).collect()
    touched = [r[0] for r in by_bucket]
    if not touched:
        return
    highest = highest_key(spark, target, surrogate, fmt)
    open_end, at_mark = (F.lit(d).cast("date") for d in (OPEN_END, since_day))
    end, day = named(roles.valid_to), named(roles.date_key).cast("date")
    is_open = (end == open_end) & F.col(BUCKET).isin(touched)
    result = held.filter(is_open | (end == at_mark)).drop(BUCKET)
    mine = rows.filter(bucket(rows, keys, n).isin(touched))
    if any(r.is_corrected for r in by_bucket):
        # The day of the mark has been corrected since.  Keys that it lacks are closed by the
        # next day.
        updates = materialize(snapshot_updates(mine.filter(day == at_mark), roles), "snapshot")
        result = apply_snapshot(updates, result, roles, highest, missing=False)
        result = materialize(result, "corrected")
        highest = max(highest, max_surrogate(result, surrogate).first()[0])
    if not rows.filter(day > at_mark).isEmpty():
        result = extend_history(mine, result, roles, since_day, highest, days=rows)
    made, seen = _observed(result, surrogate)
    # Folders of a change that have no rows any more: those of open versions all of which end.
    chosen = "|".join(re.escape(f"/{BUCKET}={label}") for label in touched)
    pattern = f"^/{re.escape(roles.valid_to)}={OPEN_END}({chosen})$"
    before = leaf_files(spark, target, pattern)
    with rewriting(spark, target, "highest") as changed:
        overwrite_partitions(_laid(made, roles, n), target, layout, fmt)
        remove_unchanged(spark, before, pattern, target)
        changed["highest"] = max(highest, seen.get.get("highest") or 0)
