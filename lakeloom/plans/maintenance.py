"""Upkeep of catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from lakeloom.functions import named
from lakeloom.shared import materialize, scratch_tables


def compact_catalog_table(spark: SparkSession, table: str) -> None:
    """Rewrite a table as fewer, larger files, and refresh what sessions know of it."""
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    with scratch_tables(spark):
        rows = materialize(spark.table(table), "compact")
        rows.hint("rebalance", *map(named, parts)).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def compact_catalog_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    """The same for each given table; ``table_inventory`` lists them."""
    for table in tables:
        compact_catalog_table(spark, table)
