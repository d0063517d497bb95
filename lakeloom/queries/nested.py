"""Flattening.  Nested rows are built per row, so no group is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import nested
from lakeloom.queries import register
from lakeloom.queries.inputs import portable, table
from lakeloom.queries.projections import labelled_documents


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per order line: structs, a struct in a struct, and two levels of arrays."""

    def measure(name: str, column: str):
        return F.struct(
            F.lit(name).alias("name"),
            F.struct(
                F.col(column).alias("amount"), F.lit(len(name)).alias("digits")
            ).alias("value"),
        )

    return table(spark, sf_dir, "lineitem").select(
        F.struct(
            F.col("l_orderkey").alias("order"),
            F.struct(F.col("l_linenumber").alias("number")).alias("line"),
        ).alias("key"),
        F.array(measure("part", "l_partkey"), measure("supplier", "l_suppkey")).alias("measures"),
        F.array(F.array("l_returnflag", "l_linestatus")).alias("flags"),
    )


@register("""
WITH parts AS (
  SELECT doc_id, unnest(CASE WHEN quality IS NULL THEN [NULL] ELSE [quality, toxic] END) AS marks
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, lang AS origin_lang, source AS origin_source, CAST(marks AS BIGINT) AS marks
FROM parts JOIN documents USING (doc_id)""")
def flatten_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = labelled_documents(spark, sf_dir).select(
        "doc_id",
        F.struct("lang", "source").alias("origin"),
        # Unlabelled documents have no array; their row stays, with NULL.
        F.when(F.col("quality").isNotNull(), F.array("quality", "toxic")).alias("marks"),
    )
    return portable(nested.flatten_once(documents, ["origin", "marks"]))


@register("""
WITH measures AS (
  SELECT *, 'part' AS measures_name, l_partkey AS measures_value_amount,
    4 AS measures_value_digits FROM lineitem
  UNION ALL SELECT *, 'supplier', l_suppkey, 8 FROM lineitem),
both_levels AS (
  SELECT *, l_returnflag AS flags FROM measures UNION ALL SELECT *, l_linestatus FROM measures)
SELECT l_orderkey AS key_order, CAST(l_linenumber AS BIGINT) AS key_line_number, measures_name,
  measures_value_amount, CAST(measures_value_digits AS BIGINT) AS measures_value_digits, flags
FROM both_levels""")
def flatten_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(nested.flatten_all(nested_lines(spark, sf_dir)))


@register("""
WITH measures AS (
  SELECT *, 'part' AS name, l_partkey AS amount FROM lineitem
  UNION ALL SELECT *, 'supplier', l_suppkey FROM lineitem)
SELECT l_orderkey AS key_order, name AS measures_name, amount, l_linestatus AS status FROM measures
""")
def flatten_by_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = [
        {"depth": 2, "column": "measures"},
        {"depth": 1, "column": "measures"},
        {"depth": 1, "column": "key"},
    ]
    flat = nested.flatten_by_settings(nested_lines(spark, sf_dir), settings)
    return flat.select(
        "key_order",
        "measures_name",
        F.col("measures_value.amount").alias("amount"),
        F.col("flags")[0][1].alias("status"),
    )


@register("""
WITH both_items AS (
  SELECT event_id, event_type AS item_name, CAST(user_id AS BIGINT) AS item_slot FROM events
  UNION ALL SELECT event_id, 'k', CAST(json_extract(props, '$.k') AS BIGINT) FROM events)
SELECT event_id, item_name, item_slot FROM both_items""")
def json_text_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    def item(name, slot):
        return F.struct(
            F.struct(name.alias("name")).alias("item"), slot.cast("bigint").alias("slot")
        )

    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(
            F.array(
                item(F.col("event_type"), F.col("user_id")),
                item(F.lit("k"), F.get_json_object("props", "$.k")),
            )
        ).alias("items"),
    )
    schema = "array<struct<item:struct<name:string>,slot:bigint>>"
    exploded = events.select("event_id", F.explode_outer(F.from_json("items", schema)).alias("i"))
    return exploded.select(
        "event_id", F.col("i.item.name").alias("item_name"), F.col("i.slot").alias("item_slot")
    )
