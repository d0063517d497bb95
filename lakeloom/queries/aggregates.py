"""Aggregates, duplicates, latest rows and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import hashing
from lakeloom.operators import aggregates, dedup, filters, history, keys, marks, segments
from lakeloom.queries import register
from lakeloom.queries.inputs import (
    CUSTOMERS_SQL,
    DAILY_SQL,
    DIMENSION,
    LINES_OUT,
    LINES_SQL,
    LINE_KEY,
    LINE_TIES,
    daily_state,
    held_customers,
    incoming_customers,
    portable,
    raw_lines,
    table,
)
from lakeloom.queries.projections import flagged_documents, labelled_documents


def stamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "partition", F.date_format("ts", "yyyyMMddHHmmss")
    )


@register("SELECT max(strftime(ts, '%Y%m%d%H%M%S')) AS partition FROM events")
def max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marks.max_mark(stamped_events(spark, sf_dir), "partition")


@register("SELECT coalesce(max(o_orderkey), 0) AS max_surrogate FROM orders")
def max_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.max_surrogate(table(spark, sf_dir, "orders"), "o_orderkey")


@register("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY))


@register("""
SELECT l_orderkey, l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
FROM lineitem GROUP BY ALL""")
def grouped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return aggregates.grouped_sum(
        lineitem, ["l_orderkey", "l_returnflag"], "l_linenumber", "line_sum"
    )


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM raw_lines
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC,
           l_linestatus DESC, ship_date DESC) = 1""")
def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(dedup.any_per_key(raw_lines(spark, sf_dir), LINE_KEY))


@register("SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"])


@register("""
SELECT count(*) AS rows_in, count(*) FILTER (quality = 1 AND toxic = 0) AS rows_kept,
  count(*) - count(*) FILTER (quality = 1 AND toxic = 0) AS filtered_rows
FROM documents LEFT JOIN labels USING (doc_id)""")
def filter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_metrics(flagged_documents(spark, sf_dir), ["is_good", "is_clean"])


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM raw_lines
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC,
           l_linestatus DESC) = 1""")
def latest_break_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir)
    ties = [*LINE_TIES, "l_linestatus"]
    return portable(dedup.latest_per_key(lines, LINE_KEY, ["ship_date"], ties))


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM raw_lines
QUALIFY dense_rank() OVER (
  PARTITION BY l_suppkey ORDER BY l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""")
def latest_keep_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir)
    return portable(dedup.latest_per_batch(lines, ["l_suppkey"], ["l_returnflag", "l_linestatus"]))


@register(f"""
WITH {LINES_SQL}, tops AS (
  SELECT l_orderkey AS k, max(ship_date) AS d, max(l_linenumber) AS n
  FROM raw_lines GROUP BY l_orderkey)
SELECT {LINES_OUT} FROM raw_lines JOIN tops
  ON l_orderkey = k AND ship_date = d AND l_linenumber = n""")
def last_batch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir)
    return portable(dedup.last_batch(lines, ["l_orderkey"], ["ship_date", "l_linenumber"]))


@register(f"""
WITH {DAILY_SQL}, flagged AS (
  SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY dt) <> event_type
    THEN 1 ELSE 0 END AS changed FROM daily)
SELECT user_id, event_type, CAST(dt AS VARCHAR) AS dt,
  CAST(sum(changed) OVER (PARTITION BY user_id ORDER BY dt
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS group_id
FROM flagged""")
def change_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_state(spark, sf_dir)
    return portable(segments.change_groups(daily, ["user_id"], "dt", "event_type"))


@register("""
SELECT doc_id, sha256(coalesce(lang, '∅') || '||' || coalesce(CAST(quality AS VARCHAR), '∅')
  || '||' || coalesce(CAST(toxic AS VARCHAR), '∅')) AS row_hash
FROM documents LEFT JOIN labels USING (doc_id)""")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = labelled_documents(spark, sf_dir)
    return documents.select(
        "doc_id", hashing.row_hash(["lang", "quality", "toxic"]).alias("row_hash")
    )


@register("""
SELECT o_orderkey, o_custkey, o_orderpriority,
  row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS order_sk
FROM orders""")
def surrogate_key_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return keys.number_rows(orders, ["o_orderpriority", "o_custkey", "o_orderkey"], "order_sk")


@register(f"""
WITH {CUSTOMERS_SQL}
SELECT c_custkey, c_name,
  (SELECT coalesce(max(customer_sk), 0) FROM dim) + row_number() OVER (ORDER BY c_custkey)
    AS customer_sk
FROM incoming WHERE c_custkey NOT IN (SELECT c_custkey FROM dim)""")
def surrogate_key_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = history.rebuild_dimension(held_customers(spark, sf_dir), DIMENSION)
    fresh = history.new_members(incoming_customers(spark, sf_dir), dim, ["c_custkey"])
    start = keys.max_surrogate(dim, "customer_sk").scalar()
    return keys.number_rows(
        fresh.select("c_custkey", "c_name"), ["c_custkey"], "customer_sk", start
    )
