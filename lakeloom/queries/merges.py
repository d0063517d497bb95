"""Mutations and writers: finished order lines are the target, open ones the updates."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import merge
from lakeloom.operators.dedup import latest_per_key
from lakeloom.operators.filters import latest_snapshot
from lakeloom.queries import register
from lakeloom.queries.inputs import (
    LINE_COLUMNS,
    LINE_KEY,
    LINES_OUT,
    LINES_SQL,
    lines,
    of_load,
    portable,
    table,
)
from lakeloom.shared import scratch_path
from lakeloom.sources import sinks, tables
from lakeloom.sources.files import read_table


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM target ANTI JOIN updates USING (l_orderkey, l_linenumber)
UNION ALL SELECT {LINES_OUT} FROM updates""")
def merge_upsert_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = lines(spark, sf_dir, "F"), lines(spark, sf_dir, "O")
    return portable(merge.upsert(target, updates, LINE_KEY, unique=True))


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM target ANTI JOIN updates USING (l_orderkey)
UNION ALL SELECT {LINES_OUT} FROM updates""")
def merge_replace_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = lines(spark, sf_dir, "F"), lines(spark, sf_dir, "O")
    return portable(merge.replace_batches(target, updates, ["l_orderkey"]))


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM target ANTI JOIN updates USING (l_orderkey)""")
def merge_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = lines(spark, sf_dir, "F"), lines(spark, sf_dir, "O")
    return portable(merge.delete_matching(target, updates, ["l_orderkey"]))


YEARLY_SQL = """
years AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderkey, o_orderstatus
  FROM orders),
target AS (
  SELECT * FROM years
  WHERE o_orderstatus = 'F' OR order_year < (SELECT max(order_year) FROM years) QUALIFY row_number() OVER (
    PARTITION BY o_custkey, order_year ORDER BY o_orderkey DESC) = 1),
updates AS (
  SELECT * FROM years WHERE order_year = (SELECT max(order_year) FROM years)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)"""


@register(f"""
WITH {YEARLY_SQL}
SELECT * FROM target WHERE NOT (
  order_year IN (SELECT order_year FROM updates) AND o_custkey IN (SELECT o_custkey FROM updates))
UNION ALL SELECT * FROM updates""")
def partition_scoped_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order of a year, of the newest year the last finished one, updated
    by all orders of the newest year.  A customer's rows of other years are out of scope and
    stay."""
    years = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        "o_orderkey",
        "o_orderstatus",
    )
    newest = latest_snapshot(years, "order_year")
    known = of_load("o_orderstatus", "F") | (
        F.col("order_year") < years.agg(F.max("order_year")).scalar()
    )
    target = latest_per_key(years.filter(known), ["o_custkey", "order_year"], ["o_orderkey"])
    updates = latest_per_key(newest, ["o_custkey"], ["o_orderkey"])
    by_customer = partial(merge.upsert, keys=["o_custkey"], unique=True)
    return merge.merge_in_partitions(target, updates, ["order_year"], by_customer)


@register(f"WITH {LINES_SQL} SELECT {LINES_OUT} FROM updates")
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "write-overwrite")
    sinks.overwrite(lines(spark, sf_dir, "F").drop("ship_date"), path)
    sinks.overwrite(lines(spark, sf_dir, "O"), path, ["l_returnflag"])
    return portable(read_table(spark, path).select(*LINE_COLUMNS))


@register(f"""
WITH {LINES_SQL} SELECT {LINES_OUT} FROM target UNION ALL SELECT {LINES_OUT} FROM updates""")
def write_append_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "write-append")
    sinks.overwrite(lines(spark, sf_dir, "F"), path, ["l_returnflag"])
    sinks.append_strict(lines(spark, sf_dir, "O"), path, ["l_returnflag"])
    return portable(read_table(spark, path).select(*LINE_COLUMNS))


@register(f"""
WITH {LINES_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_linestatus,
  CASE WHEN l_linestatus = 'F' THEN CAST(ship_date AS VARCHAR) END AS ship_date,
  CASE WHEN l_linestatus = 'O' THEN l_suppkey END AS l_suppkey
FROM loads""")
def write_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "write-evolve")
    kept = [*LINE_KEY, "l_quantity", "l_linestatus"]
    sinks.overwrite(lines(spark, sf_dir, "F").select("ship_date", *kept), path, ["l_linestatus"])
    later = lines(spark, sf_dir, "O").select("l_suppkey", *kept)
    sinks.append_evolve(later, path, ["l_linestatus"])
    evolved = read_table(spark, path, evolved=True)
    return portable(evolved.select(*kept, "ship_date", "l_suppkey"))


@register("""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem""")
def identity_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "copy")
    sinks.copy_table(spark, f"{sf_dir}/lineitem.parquet", path)
    return portable(read_table(spark, path))


@register("""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::BIGINT AS o_custkey, o_orderstatus,
  o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  TRY_CAST(o_orderpriority AS BIGINT) AS o_orderpriority
FROM orders""")
def identity_transfer_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "copy")
    types = {"o_orderkey": "string", "o_custkey": "bigint", "o_orderdate": "date", "o_orderpriority": "int"}
    sinks.copy_table(spark, f"{sf_dir}/orders.parquet", path, types=types)
    day, rank = F.col("o_orderdate").cast("string"), F.col("o_orderpriority").cast("bigint")
    return read_table(spark, path).withColumns({"o_orderdate": day, "o_orderpriority": rank})


@register("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, left(c_name, 12) AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, left(c_mktsegment, 4) AS c_mktsegment,
  CAST(NULL AS VARCHAR) AS c_comment
FROM customer""")
def reload_fixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "reload")
    schema = (
        "c_custkey string, c_name varchar(12), c_nationkey bigint, c_mktsegment varchar(4), "
        "c_comment varchar(100)"
    )
    sinks.reload(spark, f"{sf_dir}/customer.parquet", path, schema)
    return read_table(spark, path)


@register("""
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier""")
def passthrough_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(tables.passthrough_view(table(spark, sf_dir, "supplier"), "dim_supplier"))


@register(f"WITH {LINES_SQL} SELECT {LINES_OUT} FROM loads")
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that many small appends have left in small files, put together in place."""
    path = scratch_path(spark, "small-files")
    for status in ("F", "O"):
        load = lines(spark, sf_dir, status).repartition(16)
        load.write.mode("append").partitionBy("l_linestatus").parquet(path)
    sinks.compact(spark, path, path)
    return portable(read_table(spark, path).select(*LINE_COLUMNS))
