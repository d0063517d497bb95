"""Type-1 and type-2 dimensions.

Several source rows for one key (and date) are reduced to one first, so every window over a
primary key holds at most one row per date: a key with a third of all rows is as many rows here
as there are days.  Changes along other columns are counted by ``segments.change_groups``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.constants import OPEN_END
from lakeloom.functions import named
from lakeloom.functions.hashing import row_hash
from lakeloom.operators.dedup import latest_per_key, require_unique
from lakeloom.operators.filters import drop_null_keys, latest_snapshot
from lakeloom.operators.keys import max_surrogate, number_rows
from lakeloom.roles import DimensionRoles, HistoryRoles
from lakeloom.shared import materialize


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


# --- type 1 ---------------------------------------------------------------------------


def clean_members(source: DataFrame, roles: DimensionRoles) -> DataFrame:
    """Rows with a whole business key, the latest one per key."""
    return latest_per_key(
        drop_null_keys(source, roles.business_keys), roles.business_keys, roles.order_by
    )


def new_members(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.join(target.select(*map(named, keys)), list(keys), "left_anti").select(
        *map(named, source.columns)
    )


def existing_members(
    source: DataFrame, target: DataFrame, keys: Sequence[str], surrogate_key: str
) -> DataFrame:
    """Source rows already in the dimension; their surrogate key is left NULL here."""
    found = source.join(target.select(*map(named, keys)), list(keys), "left_semi")
    blank = F.lit(None).cast(target.schema[surrogate_key].dataType)
    return found.select(*map(named, source.columns), blank.alias(surrogate_key))


def rebuild_dimension(source: DataFrame, roles: DimensionRoles) -> DataFrame:
    """One row per business key, numbered in key order.  Without an order column the source
    must have one row per key already; anything else would be a guess."""
    if roles.order_by:
        members = clean_members(source, roles)
    else:
        members = drop_null_keys(source, roles.business_keys)
        require_unique(members, roles.business_keys)
    return number_rows(members, roles.business_keys, roles.surrogate_key)


def check_attributes(source: DataFrame, target: DataFrame) -> None:
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"The dimension has no columns {unknown}.")


def update_dimension(
    source: DataFrame,
    target: DataFrame,
    roles: DimensionRoles,
    start: int | Column | None = None,
) -> DataFrame:
    """Overwrite the attributes of known keys, keep their surrogate keys, and number new keys
    from ``start``, by default the target's present maximum.  Known and untouched members need
    one join, new ones another; the source's members are written once for both."""
    keys, surrogate = list(roles.business_keys), roles.surrogate_key
    check_attributes(source.drop(surrogate), target)
    source = materialize(clean_members(source, roles).drop(surrogate), "members")
    attributes = [c for c in source.columns if c not in keys]

    incoming = source.select(
        *map(named, keys),
        *[named(c).alias(f"__new_{c}") for c in attributes],
        F.lit(True).alias("__hit"),
    )
    kept = target.join(incoming, keys, "left").select(
        *[
            F.when(F.col("__hit"), named(f"__new_{f.name}").cast(f.dataType))
            .otherwise(named(f.name))
            .alias(f.name)
            if f.name in attributes
            else named(f.name)
            for f in target.schema.fields
        ]
    )
    if start is None:
        start = max_surrogate(target, surrogate).scalar()
    added = number_rows(new_members(source, target, keys), keys, surrogate, start=start)
    added = added.select(
        *[
            (named(f.name) if f.name in added.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )
    return kept.unionByName(added)


# --- type 2 ---------------------------------------------------------------------------


def _states(source: DataFrame, roles: HistoryRoles, unique: bool) -> DataFrame:
    """Rows with a key and a date, hashed, one per key and day."""
    states = drop_null_keys(source, [*roles.primary_keys, roles.date_key])
    states = states.withColumn(roles.valid_from, named(roles.date_key).cast("date"))
    if not unique:
        states = latest_per_key(
            states, [*roles.primary_keys, roles.valid_from], [roles.date_key]
        )
    return states.withColumn(roles.row_hash, row_hash(roles.tracked))


def _days(source: DataFrame, roles: HistoryRoles, mark: Column | None = None) -> DataFrame:
    """Each snapshot day (``mark`` included) with the one after it.  One row per day, so one
    window over all of them is enough."""
    dated = drop_null_keys(source, [*roles.primary_keys, roles.date_key])
    days = dated.select(named(roles.date_key).cast("date").alias("__day"))
    if mark is not None:
        days = days.distinct().union(source.sparkSession.range(1).select(mark))
    return days.distinct().withColumn("__next_day", F.lead("__day").over(Window.orderBy("__day")))


def _versions(states: DataFrame, days: DataFrame | None, roles: HistoryRoles) -> DataFrame:
    """Versions out of states (one per key and day, hashed): a version starts where the hash
    changes, or where the key returns after a snapshot without it, and ends where the next one
    starts or the key is first missing.  Without ``days`` a missing key is not noticed.

    States that neither start nor end a version are dropped before the ends are looked up."""
    day, change = named(roles.valid_from), named(roles.row_hash)
    in_key = Window.partitionBy(*map(named, roles.primary_keys)).orderBy(day)
    starts = F.lag(change).over(in_key).isNull() | (F.lag(change).over(in_key) != change)
    gone = F.lit(None).cast("date")
    if days is not None:
        states = states.join(days, day == F.col("__day"), "left").drop("__day")
        upcoming, next_day = F.lead(day).over(in_key), F.col("__next_day")
        starts = starts | F.coalesce(F.lag(next_day).over(in_key) < day, F.lit(False))
        gone = F.when(upcoming.isNull() | (upcoming > next_day), next_day)
    marked = states.withColumn("__starts", starts).withColumn("__gone", gone)
    marked = marked.filter(F.col("__starts") | F.col("__gone").isNotNull())
    following = F.lead(F.when(F.col("__starts"), day).otherwise(F.col("__gone"))).over(in_key)
    return (
        marked.withColumn(roles.valid_to, F.coalesce("__gone", following, _open_end()))
        .filter("__starts")
        .withColumn(roles.is_current, named(roles.valid_to) == _open_end())
        .drop("__starts", "__gone", "__next_day")
    )


def build_history(
    source: DataFrame, roles: HistoryRoles, unique: bool = False, close_missing: bool = False
) -> DataFrame:
    """All versions of every key from all its dated states.

    Of the rows of a version the first one is kept.  ``close_missing`` takes every day for a
    whole snapshot and closes keys that a day lacks, as increments do; otherwise they stay
    open.  Say ``unique`` where a key has one row per day, to save a shuffle."""
    states = _states(source, roles, unique)
    days = _days(source, roles) if close_missing else None
    versions = number_rows(
        _versions(states, days, roles), [*roles.primary_keys, roles.valid_from], roles.surrogate_key
    )
    return versions.select(
        *[named(c) for c in source.columns if c not in roles.generated],
        *map(named, roles.generated),
    )


def snapshot_updates(source: DataFrame, roles: HistoryRoles) -> DataFrame:
    """The newest dated snapshot as open versions, not numbered yet."""
    return (
        _states(latest_snapshot(source, roles.date_key), roles, unique=False)
        .withColumn(roles.valid_to, _open_end())
        .withColumn(roles.is_current, F.lit(True))
    )


def _current(target: DataFrame, roles: HistoryRoles) -> DataFrame:
    return target.filter(named(roles.is_current))


def _not_current(target: DataFrame, roles: HistoryRoles) -> DataFrame:
    return target.filter(~F.coalesce(named(roles.is_current), F.lit(False)))


def changed_rows(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """Updates whose key is current in the target under another hash."""
    keys = list(roles.primary_keys)
    held = _current(target, roles).select(*map(named, keys), named(roles.row_hash).alias("__held"))
    return (
        updates.join(held, keys, "inner")
        .filter(F.col("__held") != named(roles.row_hash))
        .select(*map(named, updates.columns))
    )


def missing_keys(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """Current keys of the target that the newest snapshot no longer has."""
    keys = list(roles.primary_keys)
    held = _current(target, roles).select(*map(named, keys))
    return held.join(updates.select(*map(named, keys)), keys, "left_anti")


def new_versions(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """Updates whose key has no current row in the target."""
    return new_members(updates, _current(target, roles), roles.primary_keys)


def insert_new(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """The target plus the updates whose key has no current row."""
    fresh = new_versions(updates, target, roles)
    return target.unionByName(fresh.select(*map(named, target.columns)))


def _close(
    target: DataFrame, updates: DataFrame, roles: HistoryRoles, changed: bool, missing: bool
) -> DataFrame:
    """Close current rows that changed and/or went missing: one left join, no rows added."""
    keys = list(roles.primary_keys)
    incoming = updates.select(
        *map(named, keys),
        named(roles.row_hash).alias("__hash"),
        named(roles.valid_from).alias("__from"),
    )
    newest = updates.agg(F.max(named(roles.valid_from))).scalar()
    end = F.lit(None).cast("date")
    if changed:
        end = F.when(F.col("__hash") != named(roles.row_hash), F.col("__from")).otherwise(end)
    if missing:
        # Without any update there is no newest date, and nothing is closed.
        end = F.when(F.col("__hash").isNull(), newest).otherwise(end)
    joined = _current(target, roles).join(incoming, keys, "left").withColumn("__end", end)
    return joined.select(
        *[
            F.coalesce(F.col("__end"), named(c)).alias(c)
            if c == roles.valid_to
            else F.col("__end").isNull().alias(c)
            if c == roles.is_current
            else named(c)
            for c in target.columns
        ]
    )


def expire_updated(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """The target with changed current rows closed at the start of the new version."""
    closed = _close(target, updates, roles, changed=True, missing=False)
    return _not_current(target, roles).unionByName(closed)


def expire_deleted(updates: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """The target with current rows of missing keys closed at the newest date."""
    closed = _close(target, updates, roles, changed=False, missing=True)
    return _not_current(target, roles).unionByName(closed)


def number_versions(
    updates: DataFrame, target: DataFrame, roles: HistoryRoles, start: int | Column | None = None
) -> DataFrame:
    """Number the given versions from the target's present maximum."""
    if start is None:
        start = max_surrogate(target, roles.surrogate_key).scalar()
    return number_rows(
        updates, [*roles.primary_keys, roles.row_hash], roles.surrogate_key, start=start
    )


def apply_snapshot(
    updates: DataFrame,
    target: DataFrame,
    roles: HistoryRoles,
    start: int | Column | None = None,
    missing: bool = True,
) -> DataFrame:
    """The target after the newest snapshot: changed and missing keys closed, changed and new
    keys opened.  Without ``missing``, keys that the snapshot lacks stay as they are.

    One left join settles every current row and one anti join finds every row to open (no
    current row with its key and hash), so the target's closed rows take part in no join.
    Only opened rows are numbered, without gaps."""
    keys = [*roles.primary_keys, roles.row_hash]
    held = _current(target, roles).select(*map(named, keys))
    opened = updates.join(held, keys, "left_anti")
    opened = number_versions(opened, target, roles, start).select(
        *[named(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )
    settled = _close(target, updates, roles, changed=True, missing=missing)
    return _not_current(target, roles).unionByName(settled).unionByName(opened)


def update_history(source: DataFrame, target: DataFrame, roles: HistoryRoles) -> DataFrame:
    """``snapshot_updates`` of the source, applied to the target.  The updates are used three
    times, so they are written once; a snapshot is small against the history."""
    updates = materialize(snapshot_updates(source, roles), "snapshot")
    return apply_snapshot(updates, target, roles)


def affected_keys(
    source: DataFrame, target: DataFrame, roles: HistoryRoles, mark: Any
) -> DataFrame:
    """Keys whose versions the days of ``source`` change, with ``is_corrected`` for those that
    the mark's own day changes.

    A key is left alone if each day after the mark has it in the state that is current, and
    the mark's day, if it has the key, too.  States are hashed and combined map-side, and of
    the target only the keys and hashes of current versions are read."""
    keys, at_mark = list(roles.primary_keys), F.lit(mark).cast("date")
    states = _states(source.filter(named(roles.date_key).cast("date") >= at_mark), roles, unique=False)
    day, change = named(roles.valid_from), named(roles.row_hash)
    later = day > at_mark
    seen = states.groupBy(*map(named, keys)).agg(
        F.count_if(later).alias("__days"),
        F.min(F.when(later, change)).alias("__least"),
        F.max(F.when(later, change)).alias("__most"),
        F.max(F.when(day == at_mark, change)).alias("__again"),
    )
    held = _current(target, roles).select(*map(named, keys), change.alias("__held"))
    n = states.filter(later).select(day).distinct().agg(F.count("*")).scalar()
    same = (F.col("__days") == n) & (
        (n == 0) | ((F.col("__least") == F.col("__held")) & (F.col("__most") == F.col("__held")))
    )
    again = F.coalesce(F.col("__again") != F.col("__held"), F.col("__again").isNotNull() & F.col("__held").isNull())
    found = held.join(seen, keys, "full")
    gone = F.col("__days").isNull() & (n > 0)
    changed = gone | again | (F.col("__days").isNotNull() & ~F.coalesce(same, F.lit(False)))
    return found.withColumn("is_corrected", again).filter(changed).select(*map(named, keys), "is_corrected")


def extend_history(
    source: DataFrame,
    target: DataFrame,
    roles: HistoryRoles,
    mark: Any,
    start: int | Column | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """The target after *all* snapshots later than ``mark``, the last date it has loaded: the
    result of applying them one by one, in a single pass over the new days.

    The current rows stand for the state at ``mark``.  Their versions keep their rows and
    keys and at most get an end; the other versions are new.  Where source and target hold
    some of the keys, ``days`` are rows of all of them: they tell which days have come."""
    at_mark, keys = F.lit(mark).cast("date"), list(roles.primary_keys)
    later = source.filter(named(roles.date_key).cast("date") > at_mark)
    fresh = _states(later, roles, unique=False)
    current = _current(target, roles)
    carried = current.select(
        *[at_mark.alias(c) if c == roles.valid_from else named(c) for c in target.columns]
    )
    states = carried.unionByName(fresh, allowMissingColumns=True)
    if days is not None:
        days = days.filter(named(roles.date_key).cast("date") > at_mark)
    versions = _versions(
        states.drop(roles.valid_to, roles.is_current),
        _days(later if days is None else days, roles, at_mark),
        roles,
    )

    is_carried = named(roles.valid_from) == at_mark
    ends = versions.filter(is_carried).select(
        *map(named, keys),
        named(roles.valid_to).alias("__end"),
        named(roles.is_current).alias("__on"),
    )
    settled = current.join(ends, keys, "left").select(
        *[
            F.coalesce(F.col("__end"), named(c)).alias(c)
            if c == roles.valid_to
            else F.coalesce(F.col("__on"), named(c)).alias(c)
            if c == roles.is_current
            else named(c)
            for c in target.columns
        ]
    )
    opened = number_rows(
        versions.filter(~is_carried),
        [*keys, roles.valid_from],
        roles.surrogate_key,
        start=max_surrogate(target, roles.surrogate_key).scalar() if start is None else start,
    ).select(*[named(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return _not_current(target, roles).unionByName(settled).unionByName(opened)
