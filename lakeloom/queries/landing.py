"""Landing and scans: every query lands whole tables first, then reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.queries import register
from lakeloom.queries.inputs import (
    LINE_COLUMNS,
    LINES_OUT,
    LINES_SQL,
    of_load,
    portable,
    raw_lines,
    table,
)
from lakeloom.shared import scratch_path
from lakeloom.sources import tables
from lakeloom.sources.files import read_json_files, read_parquet_files, read_table
from lakeloom.sources.landing import land_rows, land_text

DAY = "yyyyMMdd000000"


def land_events(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON documents, one extraction stamp per day."""
    path = scratch_path(spark, "landed-json")
    events = table(spark, sf_dir, "events")
    document = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    stamped = events.select(document.alias("document"), F.date_format("ts", DAY).alias("stamp"))
    # Each row carries its own stamp here, so the rows are landed by their stamp column.
    land_text(stamped, path, stamp=F.to_timestamp("stamp", "yyyyMMddHHmmss"))
    return path


@register("""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
  CAST(value AS VARCHAR) AS value, strftime(ts, '%Y%m%d000000') AS partition
FROM events""")
def scan_json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_files(spark, land_events(spark, sf_dir), "partition")


@register("""
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y%m%d000000') AS partition
FROM events""")
def scan_json_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_files(spark, land_events(spark, sf_dir), "partition", typed=True)


@register("""
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y%m%d000000') AS partition
FROM events WHERE strftime(ts, '%Y%m%d000000') >= '20240110000000'""")
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from a stored mark on, its own stamp included."""
    path = land_events(spark, sf_dir)
    return read_json_files(spark, path, "partition", mark="20240110000000", typed=True)


@register(f"""
WITH {LINES_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_linestatus,
  CASE WHEN l_linestatus = 'F' THEN l_partkey END AS l_partkey,
  CASE WHEN l_linestatus IS DISTINCT FROM 'F' THEN CAST(ship_date AS VARCHAR) END AS ship_date,
  CASE WHEN l_linestatus = 'F' THEN '20250101000000' ELSE '20250201000000' END AS partition
FROM raw_lines""")
def scan_parquet_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extractions whose columns differ."""
    path = scratch_path(spark, "landed-parquet")
    lines = raw_lines(spark, sf_dir)
    shared = ["l_orderkey", "l_linenumber", "l_linestatus"]
    first = lines.filter(of_load("l_linestatus", "F")).select(*shared, "l_partkey")
    second = lines.filter(of_load("l_linestatus", "O")).select(*shared, "ship_date")
    land_rows(first, path, stamp="20250101000000")
    land_rows(second, path, stamp="20250201000000")
    landed = read_parquet_files(spark, path, "partition")
    return portable(landed.select(*shared, "l_partkey", "ship_date", "partition"))


@register("""
SELECT doc_id, text, '20250101000000' AS partition FROM documents""")
def land_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed-text")
    documents = table(spark, sf_dir, "documents")
    land_text(
        documents.select(F.to_json(F.struct("doc_id", "text"))), path, stamp="20250101000000"
    )
    landed = spark.read.text(path)
    parsed = landed.select(
        F.from_json("value", "doc_id bigint, text string").alias("d"),
        F.col("partition").cast("string").alias("partition"),
    )
    return parsed.select("d.doc_id", "d.text", "partition")


@register(f"WITH {LINES_SQL} SELECT {LINES_OUT}, '20250101000000' AS partition FROM raw_lines")
def land_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed-rows")
    land_rows(raw_lines(spark, sf_dir), path, stamp="20250101000000")
    landed = read_table(spark, path).select(*LINE_COLUMNS, "partition")
    return portable(landed.withColumn("partition", F.col("partition").cast("string")))


NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@register(
    " UNION ALL ".join(
        f"SELECT 'given_{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in NAMES
    )
)
def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with the rows of each given table."""
    counts = None
    for name in NAMES:
        view = tables.passthrough_view(table(spark, sf_dir, name), f"given_{name}")
        count = view.agg(F.count(F.lit(1)).alias("n_rows"))
        count = count.select(F.lit(f"given_{name}").alias("table_name"), "n_rows")
        counts = count if counts is None else counts.unionByName(count)
    return tables.table_inventory(spark).join(counts, "table_name")
