"""The session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_inventory(spark: SparkSession) -> DataFrame:
    """Every table of every schema, as ``schema.table``; temporary views by name alone."""
    names = {
        (".".join([*(table.namespace or []), table.name]),)
        for schema in spark.catalog.listDatabases()
        for table in spark.catalog.listTables(schema.name)
    }
    return spark.createDataFrame(sorted(names), "table_name string")


def passthrough_view(df: DataFrame, name: str) -> DataFrame:
    """A named view of a table, unchanged."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def permanent_view(spark: SparkSession, name: str, source: str) -> DataFrame:
    """A catalog view of ``source``: a table name, or files as ``parquet.`path```."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {source}")
    return spark.table(name)
