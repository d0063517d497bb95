"""Inputs that Spark derives from the given tables, and the same as SQL for the check."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from lakeloom.operators.dedup import latest_per_key
from lakeloom.roles import DimensionRoles, HistoryRoles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Types that two engines print alike: dates and times as text, integers as bigint."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            column = column.cast("bigint")
        columns.append(column.alias(f.name))
    return df.select(*columns)


# --- order lines in two loads: finished lines are the target, open ones the updates ----

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
LINE_COLUMNS = [
    *LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "ship_date",
]


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("ship_date", F.to_date("l_shipdate")).select(*LINE_COLUMNS)


def of_load(status: Column | str, load: str) -> Column:
    """Whether a row belongs to a load: finished ones to ``F``, all others to ``O``."""
    finished = F.coalesce(F.col(status) if isinstance(status, str) else status, F.lit("")) == "F"
    return finished if load == "F" else ~finished


def lines(spark: SparkSession, sf_dir: str, load: str) -> DataFrame:
    """The lines of one load, the latest one per line key."""
    load = raw_lines(spark, sf_dir).filter(of_load("l_linestatus", load))
    return latest_per_key(load, LINE_KEY, ["ship_date"], LINE_TIES)


LINES_SQL = """
raw_lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus,
         CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
ranked_lines AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_linestatus IS NOT DISTINCT FROM 'F', l_orderkey, l_linenumber
    ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC
  ) AS rn FROM raw_lines),
loads AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus,
         ship_date FROM ranked_lines WHERE rn = 1),
target AS (SELECT * FROM loads WHERE l_linestatus = 'F'),
updates AS (SELECT * FROM loads WHERE l_linestatus IS DISTINCT FROM 'F')"""

LINES_OUT = """l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_returnflag, l_linestatus, CAST(ship_date AS VARCHAR) AS ship_date"""


# --- one state per user and day --------------------------------------------------------

HISTORY = HistoryRoles(
    primary_keys=("user_id",),
    tracked=("event_type",),
    date_key="dt",
    valid_from="valid_from",
    valid_to="valid_to",
    is_current="is_current",
    row_hash="row_hash",
    surrogate_key="history_sk",
)


def daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of each user's last event of a day."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("dt"), "ts", "event_id", "event_type"
    )
    last = latest_per_key(events, ["user_id", "dt"], ["ts", "event_id"])
    return last.select("user_id", "event_type", "dt")


#: Days that an increment of several days brings.
NEW_DAYS = 3


def last_days(daily: DataFrame, n: int = NEW_DAYS) -> Any:
    """The last day but ``n``."""
    days = daily.select("dt").distinct().orderBy(F.col("dt").desc()).limit(n + 1)
    return days.agg(F.min("dt")).first()[0]


def before_last_day(daily: DataFrame) -> DataFrame:
    newest = daily.agg(F.max("dt")).scalar()
    return daily.filter(F.col("dt") < newest)


DAILY_SQL = """
daily AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS dt FROM events
  QUALIFY row_number() OVER (
    PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)"""


def history_sql(daily: str, name: str) -> str:
    """The versions of ``daily`` as CTE ``name``."""
    return f"""
{name}_hashed AS (SELECT *, sha256(coalesce(event_type, '∅')) AS row_hash FROM {daily}),
{name}_lagged AS (
  SELECT *, lag(row_hash) OVER (PARTITION BY user_id ORDER BY dt) AS before FROM {name}_hashed),
{name}_starts AS (
  SELECT user_id, event_type, dt, row_hash, dt AS valid_from FROM {name}_lagged
  WHERE before IS NULL OR before <> row_hash),
{name}_ended AS (
  SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from),
                     DATE '9999-12-31') AS valid_to FROM {name}_starts),
{name} AS (
  SELECT user_id, event_type, dt, row_hash, valid_from, valid_to,
         valid_to = DATE '9999-12-31' AS is_current,
         row_number() OVER (ORDER BY user_id, valid_from) AS history_sk
  FROM {name}_ended)"""


HISTORY_OUT = """user_id, event_type, CAST(dt AS VARCHAR) AS dt, row_hash,
  CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
  is_current, history_sk"""


# --- customers: those in credit are the dimension; the source has the others, and those of
# --- one market segment again with changed names

DIMENSION = DimensionRoles(business_keys=("c_custkey",), surrogate_key="customer_sk")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    in_credit = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False)).alias("in_credit")
    return table(spark, sf_dir, "customer").select(*columns, in_credit)


def held_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).filter("in_credit").drop("in_credit")


def incoming_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of an update: names have changed since the dimension was built."""
    again = F.coalesce(F.col("c_mktsegment") == "BUILDING", F.lit(False))
    found = customers(spark, sf_dir).filter(~F.col("in_credit") | again).drop("in_credit")
    return found.withColumn("c_name", F.upper("c_name"))


CUSTOMERS_SQL = """
split AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, coalesce(c_acctbal >= 0, false) AS in_credit
  FROM customer),
held AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM split WHERE in_credit),
dim AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM held),
incoming AS (
  SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_mktsegment FROM split
  WHERE NOT in_credit OR coalesce(c_mktsegment = 'BUILDING', false))"""
