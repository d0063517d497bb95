"""Type-1 dimensions over customers and type-2 histories over daily user states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import history
from lakeloom.plans import gold
from lakeloom.queries import register
from lakeloom.queries.inputs import (
    CUSTOMERS_SQL,
    DAILY_SQL,
    DIMENSION,
    HISTORY,
    HISTORY_OUT,
    NEW_DAYS,
    before_last_day,
    customers,
    daily_state,
    history_sql,
    held_customers,
    incoming_customers,
    last_days,
    portable,
)
from lakeloom.shared import materialize, scratch_path
from lakeloom.sources.files import read_table

CUSTOMER_OUT = (
    "c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, customer_sk"
)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.rebuild_dimension(held_customers(spark, sf_dir), DIMENSION)


@register(f"""
WITH whole AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM customer)
SELECT {CUSTOMER_OUT} FROM whole""")
def scd1_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = customers(spark, sf_dir).drop("in_credit")
    return portable(history.rebuild_dimension(whole, DIMENSION))


@register(f"""
WITH {CUSTOMERS_SQL}
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM incoming ANTI JOIN held USING (c_custkey)""")
def scd1_new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = incoming_customers(spark, sf_dir), held_customers(spark, sf_dir)
    return portable(history.new_members(source, target, ["c_custkey"]))


@register(f"""
WITH {CUSTOMERS_SQL}
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment,
  CAST(NULL AS BIGINT) AS customer_sk
FROM incoming SEMI JOIN held USING (c_custkey)""")
def scd1_existing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = incoming_customers(spark, sf_dir), dimension(spark, sf_dir)
    return portable(history.existing_members(source, target, ["c_custkey"], "customer_sk"))


SCD1_UPDATE_SQL = f"""
WITH {CUSTOMERS_SQL}, fresh AS (
  SELECT *, (SELECT max(customer_sk) FROM dim) + row_number() OVER (ORDER BY c_custkey)
    AS customer_sk
  FROM incoming ANTI JOIN dim USING (c_custkey))
SELECT dim.c_custkey, coalesce(incoming.c_name, dim.c_name) AS c_name,
  CAST(coalesce(incoming.c_nationkey, dim.c_nationkey) AS BIGINT) AS c_nationkey,
  coalesce(incoming.c_mktsegment, dim.c_mktsegment) AS c_mktsegment, customer_sk
FROM dim LEFT JOIN incoming ON dim.c_custkey = incoming.c_custkey
UNION ALL SELECT {CUSTOMER_OUT} FROM fresh"""


@register(SCD1_UPDATE_SQL)
def scd1_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = incoming_customers(spark, sf_dir), dimension(spark, sf_dir)
    return portable(history.update_dimension(source, target, DIMENSION))


# --- type 2 ---------------------------------------------------------------------------

# The history before the last day is the target, the last day the newest snapshot.
INCREMENT_SQL = f"""
{DAILY_SQL},
newest AS (SELECT max(dt) AS day FROM daily),
past AS (SELECT daily.* FROM daily, newest WHERE dt < day),
{history_sql("past", "target")},
updates AS (
  SELECT user_id, event_type, dt, sha256(coalesce(event_type, '∅')) AS row_hash,
    dt AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM daily, newest WHERE dt = day),
live AS (SELECT * FROM target WHERE is_current),
changed AS (
  SELECT updates.* FROM updates JOIN live ON updates.user_id = live.user_id
  WHERE updates.row_hash <> live.row_hash),
missing AS (SELECT user_id FROM live WHERE user_id NOT IN (SELECT user_id FROM updates))"""

UPDATE_OUT = """user_id, event_type, CAST(dt AS VARCHAR) AS dt, row_hash,
  CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current"""


def target_and_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # Derived from raw events here; otherwise a table that each use below scans.
    daily = materialize(daily_state(spark, sf_dir), "daily")
    target = history.build_history(before_last_day(daily), HISTORY, unique=True)
    return target, history.snapshot_updates(daily, HISTORY)


@register(f"""
WITH {DAILY_SQL}, {history_sql("daily", "versions")} SELECT {HISTORY_OUT} FROM versions""")
def scd2_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(history.build_history(daily_state(spark, sf_dir), HISTORY, unique=True))


@register(f"""
WITH {INCREMENT_SQL}
SELECT {UPDATE_OUT}, (SELECT max(history_sk) FROM target)
  + row_number() OVER (ORDER BY user_id, row_hash) AS history_sk
FROM updates""")
def scd2_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return portable(history.number_versions(updates, target, HISTORY))


@register(f"WITH {INCREMENT_SQL} SELECT {UPDATE_OUT} FROM changed")
def scd2_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return portable(history.changed_rows(updates, target, HISTORY))


@register(f"WITH {INCREMENT_SQL} SELECT user_id FROM missing")
def scd2_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return history.missing_keys(updates, target, HISTORY)


@register(f"""
WITH {INCREMENT_SQL}
SELECT {HISTORY_OUT} FROM target
UNION ALL SELECT {UPDATE_OUT}, (SELECT max(history_sk) FROM target)
  + row_number() OVER (ORDER BY user_id, row_hash)
FROM updates WHERE user_id NOT IN (SELECT user_id FROM live)""")
def scd2_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    fresh = history.new_versions(updates, target, HISTORY)
    numbered = history.number_versions(fresh, target, HISTORY)
    return portable(history.insert_new(numbered, target, HISTORY))


@register(f"""
WITH {INCREMENT_SQL}
SELECT target.user_id, target.event_type, CAST(target.dt AS VARCHAR) AS dt, target.row_hash,
  CAST(target.valid_from AS VARCHAR) AS valid_from,
  CAST(CASE WHEN is_current THEN coalesce(changed.valid_from, target.valid_to)
       ELSE target.valid_to END AS VARCHAR) AS valid_to,
  target.is_current AND changed.user_id IS NULL AS is_current, history_sk
FROM target LEFT JOIN (SELECT user_id, valid_from FROM changed) AS changed
  ON target.user_id = changed.user_id""")
def scd2_expire_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return portable(history.expire_updated(updates, target, HISTORY))


@register(f"""
WITH {INCREMENT_SQL}
SELECT user_id, event_type, CAST(dt AS VARCHAR) AS dt, row_hash,
  CAST(valid_from AS VARCHAR) AS valid_from,
  CAST(CASE WHEN is_current AND user_id IN (SELECT user_id FROM missing)
       THEN (SELECT day FROM newest) ELSE valid_to END AS VARCHAR) AS valid_to,
  is_current AND user_id NOT IN (SELECT user_id FROM missing) AS is_current, history_sk
FROM target""")
def scd2_expire_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return portable(history.expire_deleted(updates, target, HISTORY))


INCREMENT_RESULT = f"""
settled AS (
  SELECT target.user_id, target.event_type, target.dt, target.row_hash, target.valid_from,
    CASE WHEN NOT target.is_current THEN target.valid_to
         WHEN updates.user_id IS NULL THEN (SELECT day FROM newest)
         WHEN updates.row_hash <> target.row_hash THEN updates.valid_from
         ELSE target.valid_to END AS valid_to, history_sk
  FROM target LEFT JOIN updates ON target.user_id = updates.user_id),
opened AS (
  SELECT * FROM updates WHERE NOT EXISTS (
    SELECT 1 FROM live WHERE live.user_id = updates.user_id AND live.row_hash = updates.row_hash)),
result AS (
  SELECT user_id, event_type, dt, row_hash, valid_from, valid_to,
    valid_to = DATE '9999-12-31' AS is_current, history_sk FROM settled
  UNION ALL SELECT user_id, event_type, dt, row_hash, valid_from, valid_to, is_current,
    (SELECT max(history_sk) FROM target) + row_number() OVER (ORDER BY user_id, row_hash)
  FROM opened)"""


@register(f"WITH {INCREMENT_SQL}, {INCREMENT_RESULT} SELECT {HISTORY_OUT} FROM result")
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return portable(history.apply_snapshot(updates, target, HISTORY))


# The history before the last days is the target, extended by all of them at once.
EXTEND_SQL = f"""
{DAILY_SQL},
marks AS (SELECT min(dt) AS day FROM (SELECT DISTINCT dt FROM daily ORDER BY dt DESC LIMIT {NEW_DAYS + 1})),
past AS (SELECT daily.* FROM daily, marks WHERE dt <= day),
{history_sql("past", "target")},
days AS (SELECT DISTINCT dt AS day FROM daily WHERE dt >= (SELECT day FROM marks)),
nexts AS (SELECT day, lead(day) OVER (ORDER BY day) AS next_day FROM days),
states AS (
  SELECT user_id, event_type, row_hash, (SELECT day FROM marks) AS dt FROM target WHERE is_current
  UNION ALL SELECT user_id, event_type, sha256(coalesce(event_type, '∅')), dt FROM daily
  WHERE dt > (SELECT day FROM marks)),
seen AS (
  SELECT states.*, next_day, lag(row_hash) OVER w AS before, lag(next_day) OVER w AS expected,
    lead(dt) OVER w AS following
  FROM states JOIN nexts ON dt = day WINDOW w AS (PARTITION BY user_id ORDER BY dt)),
marked AS (
  SELECT *, before IS NULL OR before <> row_hash OR coalesce(expected < dt, false) AS starts,
    CASE WHEN following IS NULL OR following > next_day THEN next_day END AS gone
  FROM seen),
kept AS (
  SELECT *, lead(CASE WHEN starts THEN dt ELSE gone END) OVER (PARTITION BY user_id ORDER BY dt)
    AS later
  FROM marked WHERE starts OR gone IS NOT NULL),
fresh AS (
  SELECT user_id, event_type, dt, row_hash, dt AS valid_from,
    coalesce(gone, later, DATE '9999-12-31') AS valid_to
  FROM kept WHERE starts),
result AS (
  SELECT target.user_id, target.event_type, target.dt, target.row_hash, target.valid_from,
    CASE WHEN target.is_current THEN fresh.valid_to ELSE target.valid_to END AS valid_to, history_sk
  FROM target LEFT JOIN fresh
    ON target.user_id = fresh.user_id AND fresh.valid_from = (SELECT day FROM marks)
  UNION ALL SELECT *, (SELECT max(history_sk) FROM target)
    + row_number() OVER (ORDER BY user_id, valid_from)
  FROM fresh WHERE valid_from > (SELECT day FROM marks)),
extended AS (SELECT *, valid_to = DATE '9999-12-31' AS is_current FROM result)"""


@register(f"WITH {EXTEND_SQL} SELECT {HISTORY_OUT} FROM extended")
def scd2_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All new days in one pass, keys that leave and return among them."""
    daily = materialize(daily_state(spark, sf_dir), "daily")
    mark = last_days(daily)
    past = history.build_history(daily.filter(F.col("dt") <= F.lit(mark)), HISTORY, unique=True)
    return portable(history.extend_history(daily, materialize(past, "past"), HISTORY, mark))


@register(f"WITH {EXTEND_SQL} SELECT {HISTORY_OUT} FROM extended")
def gold_history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through tables: built from all days but the last, then extended by these in
    one call; a second call finds nothing new."""
    source, target = scratch_path(spark, "daily"), scratch_path(spark, "history")
    daily = materialize(daily_state(spark, sf_dir), "daily")
    is_past = F.col("dt") <= F.lit(last_days(daily))
    daily.filter(is_past).write.partitionBy("dt").parquet(source)
    mark = gold.update_history_table(spark, source, target, HISTORY)
    daily.filter(~is_past).write.mode("append").partitionBy("dt").parquet(source)
    mark = gold.update_history_table(spark, source, target, HISTORY, mark)
    gold.update_history_table(spark, source, target, HISTORY, mark)
    columns = ["user_id", "event_type", "dt", *HISTORY.generated]
    return portable(read_table(spark, target).select(*columns))


@register(SCD1_UPDATE_SQL)
def gold_dimension_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through tables: built from the first source, then updated from another."""
    first, second = scratch_path(spark, "customers"), scratch_path(spark, "customers")
    target = scratch_path(spark, "dimension")
    held_customers(spark, sf_dir).write.parquet(first)
    incoming_customers(spark, sf_dir).write.parquet(second)
    gold.update_dimension_table(spark, first, target, DIMENSION)
    gold.update_dimension_table(spark, second, target, DIMENSION)
    return portable(read_table(spark, target))
