"""Landed service responses, one per row of a given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import responses
from lakeloom.queries import register
from lakeloom.queries.inputs import table


@register("""
WITH items AS (
  SELECT *, url AS item_url FROM pages UNION ALL SELECT *, url || '#2' FROM pages)
SELECT page_id, NOT contains(url, '?') AS is_last_page, 'ok' AS body_status, item_url FROM items
UNION ALL SELECT page_id, true, 'empty', NULL FROM pages
UNION ALL SELECT page_id, NULL, 'unreadable', NULL FROM pages""")
def response_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of two items (another page follows where the address has a query), of none,
    and one that is cut off."""

    def item(url):
        return F.struct(F.col("page_id").cast("string").alias("name"), url.alias("url"))

    listing = F.struct(
        F.when(F.col("url").contains("?"), F.col("url")).alias("next"),
        F.array(item(F.col("url")), item(F.concat("url", F.lit("#2")))).alias("results"),
    )
    empty = F.lit('{"next": null, "results": []}')
    bodies = F.array(F.to_json(listing), empty, F.concat(F.lit("{"), F.col("url")))
    landed = table(spark, sf_dir, "pages").select("page_id", F.explode(bodies).alias("body"))
    return responses.response_items(landed, "body").drop("body")


ENVELOPE = "<response><control>{}</control><operation><result>{}</result></operation></response>"


@register("""
SELECT o_orderkey, CASE
  WHEN o_orderstatus = 'P' AND left(o_orderpriority, 1) = '1' THEN 'Status code is not 200.'
  WHEN o_orderstatus = 'P' AND left(o_orderpriority, 1) = '2' THEN NULL
  WHEN left(o_orderpriority, 1) = '1' THEN 'Session expired.'
  WHEN left(o_orderpriority, 1) = '2' THEN 'Response has an error.'
  WHEN left(o_orderpriority, 1) = '3' THEN 'Response missing status.'
  WHEN left(o_orderpriority, 1) = '4' AND o_orderstatus = 'F' THEN 'Response failed status.'
  WHEN left(o_orderpriority, 1) = '4' THEN NULL
  ELSE 'Response xml is unexpected.' END AS response_error
FROM orders""")
def response_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response per order: its priority and status decide what kind.  Those of odd orders
    have character sections, numeric references, comments and prefixes."""
    case = F.left("o_orderpriority", F.lit(1))
    partly = F.col("o_orderstatus") == "P"
    odd = F.col("o_orderkey") % 2 == 1
    error = ENVELOPE.format("<status>success</status>", "<errorno>{}</errorno>")
    noted = ENVELOPE.format(
        "<status>{}</status>",
        "<x:errorno xmlns:x='urn:x'/><note><![CDATA[<errorno>1</errorno>]]></note><!-- <errorno/> -->",
    )
    body = (
        F.when(case == "1", F.when(odd, error.format("XL0300000&#54;")).otherwise(error.format("XL03000006")))
        .when((case == "4") & odd & (F.col("o_orderstatus") == "F"), noted.format("fail<![CDATA[ure]]>"))
        .when((case == "4") & odd, noted.format("success"))
        .when(case == "2", F.format_string(error.format("PL%d"), "o_custkey"))
        .when(case == "3", F.format_string(ENVELOPE.format("<id>%d</id>", ""), "o_orderkey"))
        .when(
            case == "4",
            F.format_string(
                ENVELOPE.format("<status>%s</status>", "<status>success</status>"),
                F.when(F.col("o_orderstatus") == "F", "failure").otherwise("success"),
            ),
        )
        .otherwise(F.format_string("<response><status>%s</response>", "o_orderstatus"))
    )
    landed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(partly & (case == "1"), 500).otherwise(200).alias("status_code"),
        F.when(partly & (case == "2"), "application/json")
        .otherwise("Application/XML; charset=utf-8")
        .alias("content_type"),
        body.alias("body"),
    )
    checked = responses.response_status(landed, "status_code", "content_type", "body")
    return checked.select("o_orderkey", "response_error")


@register("""
SELECT p_partkey, 'ok' AS body_status, p_brand AS field_id FROM part
UNION ALL SELECT p_partkey, 'ok', p_type FROM part
UNION ALL SELECT p_partkey, 'ok', p_brand || '&' || p_type FROM part
UNION ALL SELECT p_partkey, 'empty', NULL FROM part
UNION ALL SELECT p_partkey, 'unreadable', NULL FROM part
UNION ALL SELECT p_partkey, 'unreadable', NULL FROM part""")
def response_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object descriptions with two identified fields and one without an identifier, with no
    field, with trailing text, and none at all."""
    text = (
        "<response><Type><Fields><Field><ID>%s</ID></Field><Field><LABEL>x</LABEL></Field>"
        "<Field><ID>%s</ID></Field></Fields></Type></response>"
    )
    landed = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.explode(
            F.array(
                F.format_string(text, "p_brand", "p_type"),
                F.format_string(
                    "<r><![CDATA[<Field><ID>x</ID></Field>]]><Field><ID>%s&#38;<![CDATA[%s]]><x/></ID></Field></r>",
                    "p_brand",
                    "p_type",
                ),
                F.lit("<response/>"),
                F.concat(F.lit("<response/>"), F.col("p_brand")),
                F.lit(None).cast("string"),
            )
        ).alias("body"),
    )
    return responses.response_fields(landed, "body").drop("body")
