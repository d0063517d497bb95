"""Whole layer updates through paths: land, load to bronze, update silver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.names import stringify
from lakeloom.plans import bronze, silver
from lakeloom.queries import register
from lakeloom.queries.inputs import (
    LINE_COLUMNS,
    LINES_OUT,
    LINES_SQL,
    of_load,
    portable,
    raw_lines,
)
from lakeloom.queries.nested import nested_lines
from lakeloom.roles import SilverRoles
from lakeloom.shared import scratch_path
from lakeloom.sources.files import read_parquet_files, read_stamped, read_table
from lakeloom.sources.landing import land_rows, land_text
from lakeloom.sources.sinks import append_evolve, overwrite

FIRST, SECOND = "20250101000000", "20250201000000"


@register(f"""
WITH measures AS (
  SELECT *, 'part' AS measures_name, l_partkey AS amount, '4' AS digits FROM lineitem
  UNION ALL SELECT *, 'supplier', l_suppkey, '8' FROM lineitem),
both_levels AS (
  SELECT *, l_returnflag AS flags FROM measures UNION ALL SELECT *, l_linestatus FROM measures)
SELECT CAST(l_orderkey AS VARCHAR) AS key_order,
  CAST(l_linenumber AS VARCHAR) AS key_line_number, measures_name,
  CAST(amount AS VARCHAR) AS measures_value_amount, digits AS measures_value_digits, flags,
  CASE l_linestatus WHEN 'F' THEN '{FIRST}' ELSE '{SECOND}' END AS partition
FROM both_levels""")
def bronze_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed extractions, loaded in two runs.  The mark is inclusive, but the second run
    finds the first stamp's files unchanged and loads them no second time."""
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "bronze")
    documents = nested_lines(spark, sf_dir)
    mark = None
    for status, stamp in (("F", FIRST), ("O", SECOND)):
        load = documents.filter(of_load(F.col("flags")[0][1], status))
        land_text(load.select(F.to_json(F.struct("*"))), landed, stamp=stamp)
        mark = bronze.update_from_json(spark, landed, target, mark=mark)
    table = read_table(spark, target, evolved=True)
    return table.withColumn("partition", F.col("partition").cast("string"))


@register(f"""
WITH {LINES_SQL}
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CASE WHEN l_linestatus = 'O' THEN CAST(ship_date AS VARCHAR) END AS shipdate, l_linestatus,
  '["' || l_returnflag || '"]' AS flags,
  CASE l_linestatus WHEN 'F' THEN '{FIRST}' ELSE '{SECOND}' END AS partition
FROM raw_lines""")
def bronze_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second extraction has one more column."""
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "bronze")
    lines = raw_lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        F.array("l_returnflag").alias("flags"),
        F.col("ship_date").alias("ship-date"),
    )
    mark = None
    for status, stamp, gone in (("F", FIRST, ["ship-date"]), ("O", SECOND, [])):
        load = lines.filter(of_load("l_linestatus", status))
        land_rows(load.drop(*gone), landed, stamp=stamp)
        mark = bronze.update_from_parquet(spark, landed, target, mark=mark)
    table = read_table(spark, target, evolved=True)
    return table.withColumn("partition", F.col("partition").cast("string"))


def line_roles(
    keys: str = "is_primary_key", filters: bool = False, with_flag: bool = False
) -> SilverRoles:
    """Typed order lines; ``keys`` says what the line or order key is used for."""
    types = {
        "l_orderkey": "bigint",
        "l_linenumber": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_quantity": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "ship_date": "date",
    }
    ordered = ["ship_date", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"]
    key_columns = ["l_orderkey"] if keys == "is_batch_key" else ["l_orderkey", "l_linenumber"]
    key_columns += ["l_returnflag"] if with_flag else []
    records = [
        {
            "expression": name,
            "column_type": kind,
            "column_name": name,
            "column_order": position,
            "is_output": 1,
            "is_partition_by": int(name == "l_returnflag"),
            "is_order_by": ordered.index(name) + 1 if name in ordered else 0,
            keys: int(name in key_columns),
        }
        for position, (name, kind) in enumerate(types.items())
    ]
    if filters:
        records.append(
            {
                "expression": "@l_returnflag != 'N'",
                "column_type": "boolean",
                "column_name": "is_returned",
                "column_order": 99,
                "is_filter": 1,
            }
        )
    return SilverRoles.parse(records)


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM raw_lines WHERE l_returnflag <> 'N'
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC,
           l_linestatus DESC) = 1""")
def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stringify(raw_lines(spark, sf_dir))
    return portable(silver.silver_transform(lines, line_roles(filters=True)))


def silver_update(
    spark: SparkSession, sf_dir: str, method: str, roles: SilverRoles, immutable: bool = False
) -> DataFrame:
    """A bronze table that grows by a second stamp, and a silver table updated after each."""
    source, target = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lines = stringify(raw_lines(spark, sf_dir))
    mark = None
    for status, stamp, save in (("F", FIRST, overwrite), ("O", SECOND, append_evolve)):
        load = lines.filter(of_load("l_linestatus", status))
        # One stamp per write, as a bronze load does it.
        load = load.withColumn("partition", F.lit(stamp))
        save(load, source, ["partition"], rebalance=False)
        mark = silver.update_silver(
            spark, source, target, roles, method,
            mark=mark, partitions_immutable=immutable, inclusive=False,
        )
    return portable(read_table(spark, target).select(*LINE_COLUMNS))


@register(f"WITH {LINES_SQL} SELECT {LINES_OUT} FROM updates")
def silver_update_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_update(spark, sf_dir, "overwrite", line_roles())


@register(f"""
WITH {LINES_SQL} SELECT {LINES_OUT} FROM target UNION ALL SELECT {LINES_OUT} FROM updates""")
def silver_update_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_update(spark, sf_dir, "append", line_roles())


@register(f"""
WITH {LINES_SQL} SELECT {LINES_OUT} FROM target UNION ALL SELECT {LINES_OUT} FROM updates""")
def silver_append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends that go on from the mark of the run before: stamps of unequal width, and a
    third run that finds nothing new."""
    source, target = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lines = stringify(raw_lines(spark, sf_dir))
    mark = None
    for status, stamp in (("F", "9"), ("O", "10"), (None, None)):
        if status:
            load = lines.filter(of_load("l_linestatus", status)).withColumn("partition", F.lit(stamp))
            append_evolve(load, source, ["partition"], rebalance=False)
        mark = silver.update_silver(spark, source, target, line_roles(), "append", mark=mark)
    return portable(read_table(spark, target).select(*LINE_COLUMNS))


@register(f"""
SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_suppkey END AS l_suppkey, '007' AS partition
FROM lineitem""")
def bronze_evolve_same_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends into one stamp, the second with a new column: none is lost."""
    path = scratch_path(spark, "evolve")
    lines = raw_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus")
    lines = lines.withColumns({"l_linenumber": F.col("l_linenumber").cast("string"), "partition": F.lit("007")})
    for status, gone in (("F", ["l_suppkey"]), ("O", [])):
        load = lines.filter(of_load("l_linestatus", status)).drop(*gone, "l_linestatus")
        append_evolve(load, path, ["partition"], rebalance=False)
    return read_stamped(spark, path, "partition", text=True)


INCREMENTS = {
    "widths": (["9", "10", "011"], "9"),
    "zeros": (["01022025", "02022025", "03022025"], "02022025"),
    "colons": (["2025-01-01 10:00:00", "2025-01-01 10:15:00", "2025-01-01 10:30:00"], "2025-01-01 10:15:00"),
}


@register("""
WITH stamps(kind, flag, stamp, wanted) AS (VALUES
  ('widths', 'A', '9', true), ('widths', 'N', '10', true), ('widths', 'R', '011', true),
  ('zeros', 'A', '01022025', false), ('zeros', 'N', '02022025', true), ('zeros', 'R', '03022025', true),
  ('colons', 'A', '2025-01-01 10:00:00', false), ('colons', 'N', '2025-01-01 10:15:00', true),
  ('colons', 'R', '2025-01-01 10:30:00', true))
SELECT kind, stamp AS partition, l_orderkey, l_linenumber::VARCHAR AS l_linenumber
FROM lineitem JOIN stamps ON flag = CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag ELSE 'R' END
WHERE wanted""")
def incremental_scan_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increments from a mark on, for stamps of unequal width, with leading zeros, with colons."""
    lines = raw_lines(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_returnflag")
    found = []
    for kind, (stamps, mark) in INCREMENTS.items():
        path, flag = scratch_path(spark, "stamps"), F.col("l_returnflag")
        stamp = F.when(flag == "A", stamps[0]).when(flag == "N", stamps[1]).otherwise(stamps[2])
        lines.withColumn("partition", stamp).drop("l_returnflag").write.partitionBy("partition").parquet(path)
        increment = read_parquet_files(spark, path, "partition", mark)
        found.append(increment.withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, found)


@register(f"""
WITH {LINES_SQL}, flagged AS (
  SELECT *, l_linestatus IS NOT DISTINCT FROM 'F' AS first_load FROM raw_lines),
latest AS (
  SELECT * FROM flagged QUALIFY row_number() OVER (
    PARTITION BY first_load, l_orderkey, l_linenumber, l_returnflag
    ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_linestatus DESC) = 1)
SELECT {LINES_OUT} FROM latest AS l WHERE NOT first_load OR NOT EXISTS (
  SELECT 1 FROM latest AS n WHERE NOT n.first_load AND n.l_orderkey = l.l_orderkey
    AND n.l_linenumber = l.l_linenumber AND n.l_returnflag = l.l_returnflag)""")
def silver_update_pk_immutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that holds its partition column never leaves its partition: only the partitions
    that the updates touch are rewritten."""
    roles = line_roles(with_flag=True)
    return silver_update(spark, sf_dir, "pk_merge", roles, immutable=True)


@register(f"""
WITH {LINES_SQL}
SELECT {LINES_OUT} FROM target ANTI JOIN updates USING (l_orderkey, l_linenumber)
UNION ALL SELECT {LINES_OUT} FROM updates""")
def silver_update_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_update(spark, sf_dir, "pk_merge", line_roles())


@register(f"""
WITH {LINES_SQL}, latest AS (
  SELECT * FROM raw_lines QUALIFY dense_rank() OVER (
    PARTITION BY l_linestatus, l_orderkey
    ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_returnflag DESC, l_linestatus DESC) = 1),
old AS (SELECT * FROM latest WHERE l_linestatus = 'F'),
new AS (SELECT * FROM latest WHERE l_linestatus = 'O')
SELECT {LINES_OUT} FROM old WHERE l_orderkey NOT IN (SELECT l_orderkey FROM new)
UNION ALL SELECT {LINES_OUT} FROM new""")
def silver_update_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_update(spark, sf_dir, "bk_merge", line_roles("is_batch_key"))
