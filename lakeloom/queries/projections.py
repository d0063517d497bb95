"""Typed projections, names, text forms and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import names, typed
from lakeloom.operators import filters
from lakeloom.queries import register
from lakeloom.queries.inputs import DAILY_SQL, daily_state, portable, table
from lakeloom.roles import TypedColumn
from lakeloom.sources import sinks


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a bronze table holds them: all text."""
    return names.stringify(table(spark, sf_dir, "orders"))


@register("""
SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderstatus AS status,
  CAST(NULL AS BIGINT) AS priority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date
FROM orders""")
def select_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        TypedColumn("o_orderkey", "bigint", "order_id"),
        TypedColumn("o_totalprice", "double", "price"),
        TypedColumn("o_orderstatus", "string", "status"),
        # Not a number, so the cast gives NULL.
        TypedColumn("o_orderpriority", "bigint", "priority"),
        TypedColumn("#datetime1(o_orderdate)", "date", "order_date"),
    ]
    return portable(typed.select_typed(text_orders(spark, sf_dir), columns))


@register("""
SELECT o_orderkey AS order_id, TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS priority,
  o_orderstatus IN ('F', 'P') AS is_started,
  o_custkey || '-' || o_orderstatus AS customer_status
FROM orders""")
def select_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        TypedColumn("o_orderkey", "bigint", "order_id"),
        TypedColumn("@left(o_orderpriority, 1)", "bigint", "priority"),
        TypedColumn("@o_orderstatus in ('F', 'P')", "boolean", "is_started"),
        TypedColumn("@concat_ws('-', o_custkey, o_orderstatus)", "string", "customer_status"),
    ]
    return portable(typed.select_typed(text_orders(spark, sf_dir), columns))


@register("""
WITH times AS (
  SELECT 'event' AS origin, event_id AS id, ts AS t, event_type AS not_a_time FROM events
  UNION ALL SELECT 'order', o_orderkey, o_orderdate, o_orderpriority FROM orders)
SELECT origin, id, strftime(t, '%Y-%m-%d %H:%M:%S') AS plain,
  strftime((date_trunc('second', t) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York',
           '%Y-%m-%d %H:%M:%S') AS local,
  strftime(t, '%Y-%m-%d %H:%M:%S') AS iso, CAST(NULL AS VARCHAR) AS unparsable
FROM times""")
def datetime_shorthand(spark: SparkSession, sf_dir: str) -> DataFrame:
    def times(name: str, origin: str, key: str, ts: str, other: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(origin).alias("origin"),
            F.col(key).alias("id"),
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("text"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso_text"),
            F.col(other).alias("not_a_time"),
        )

    both = times("events", "event", "event_id", "ts", "event_type").unionByName(
        times("orders", "order", "o_orderkey", "o_orderdate", "o_orderpriority")
    )
    columns = [
        TypedColumn("origin", "string", "origin"),
        TypedColumn("id", "bigint", "id"),
        TypedColumn("#datetime1(text)", "timestamp", "plain"),
        TypedColumn("#datetime2(text)", "timestamp", "local"),
        TypedColumn("#datetime3(iso_text)", "timestamp", "iso"),
        TypedColumn("#datetime1(not_a_time)", "timestamp", "unparsable"),
    ]
    return portable(typed.select_typed(both, columns))


@register("SELECT page_id, url AS pageurl, html AS htmltext FROM pages")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").toDF("page.id", "page url!", "html(text)")
    return names.clean_names(pages)


@register("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
  CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def stringify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.stringify(table(spark, sf_dir, "part"))


@register("""
SELECT CAST(event_id AS VARCHAR) AS event_id,
  '{"type":"' || event_type || '","user":' || user_id || '}' AS detail,
  '["' || event_type || '","' || CAST(CAST(ts AS DATE) AS VARCHAR) || '"]' AS tags,
  '{"' || event_type || '":' || user_id || '}' AS counts
FROM events""")
def stringify_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("detail"),
        F.array("event_type", F.to_date("ts").cast("string")).alias("tags"),
        F.create_map("event_type", "user_id").alias("counts"),
    )
    return names.stringify(events)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels exist for some, so their columns are NULL for the others."""
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


def flagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        "source",
        (F.col("quality") == 1).alias("is_good"),
        (F.col("toxic") == 0).alias("is_clean"),
    )


@register("""
SELECT doc_id, lang, source FROM documents JOIN labels USING (doc_id)
WHERE quality = 1 AND toxic = 0""")
def filter_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = flagged_documents(spark, sf_dir)
    return filters.keep_flagged(documents, ["is_good", "is_clean"]).drop("is_good", "is_clean")


@register("""
SELECT doc_id, lang, CAST(quality AS BIGINT) AS quality
FROM documents LEFT JOIN labels USING (doc_id)
WHERE lang IS NOT NULL AND quality IS NOT NULL""")
def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = labelled_documents(spark, sf_dir).select("doc_id", "lang", "quality")
    return portable(filters.drop_null_keys(documents, ["lang", "quality"]))


@register(f"""
WITH {DAILY_SQL}
SELECT user_id, event_type, CAST(dt AS VARCHAR) AS dt FROM daily
WHERE dt = (SELECT max(dt) FROM daily)""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(filters.latest_snapshot(daily_state(spark, sf_dir), "dt"))


@register("""
SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    return sinks.align_columns(orders, ["o_orderstatus", "vanished", "o_orderkey"])
