"""Tasks run from metadata rows: two runs each, the second from the mark that the first stored.
Rows have the mark of the last run beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.constants import HISTORY_TASK, JSON_TASK, PARQUET_TASK, SILVER_TASK
from lakeloom.plans.tasks import TaskRun, all_task_targets, run_task
from lakeloom.queries import register
from lakeloom.queries.inputs import (
    DAILY_SQL,
    HISTORY_OUT,
    LINE_COLUMNS,
    LINES_OUT,
    LINES_SQL,
    daily_state,
    history_sql,
    last_days,
    of_load,
    portable,
    raw_lines,
)
from lakeloom.queries.layers import FIRST, SECOND, line_roles
from lakeloom.queries.metadata import document_tasks
from lakeloom.queries.nested import nested_lines
from lakeloom.roles import SilverRoles
from lakeloom.shared import materialize, scratch_path
from lakeloom.sources.files import read_table
from lakeloom.sources.landing import land_rows, land_text
from lakeloom.sources.sinks import append_evolve

SOURCE = {"files": "lakefiles:w/s/files/{}", "table": "deltalake:w/s/tables/dbo/{}"}


def settings(spark: SparkSession, kind: str, area: str, **more: str) -> dict[str, DataFrame]:
    """The tables of one kind with a single task ``kind:1`` that never ran."""
    row = {
        "task_id": f"{kind}:1",
        "source_path": SOURCE[area].format("source"),
        "target_path": SOURCE["table"].format("target"),
        "full_refresh": "false",
    } | more
    mark = "min_date_key" if kind == HISTORY_TASK else "min_partition"
    return {
        kind: spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row)),
        f"{kind}_dynamic": spark.createDataFrame([], f"task_id string, {mark} string"),
    }


def role_rows(spark: SparkSession, kind: str, names: list[str], records: list[tuple]) -> DataFrame:
    kinds = ", ".join(f"{n} {'string' if isinstance(v, str) else 'int'}" for n, v in zip(names, records[0], strict=True))
    return spark.createDataFrame([(f"{kind}:1", *r) for r in records], f"task_id string, {kinds}")


def rerun(spark: SparkSession, kind: str, tables: dict[str, DataFrame], root: str) -> TaskRun:
    """Run the task, and put its marks where the next run finds them."""
    run = run_task(spark, f"{kind}:1", tables, root)
    tables[f"{kind}_dynamic"] = materialize(run.marks, "marks")
    return run


def with_mark(df: DataFrame, tables: dict[str, DataFrame], kind: str) -> DataFrame:
    held = tables[f"{kind}_dynamic"]
    return df.withColumn("task_mark", F.lit(held.first()[1]))


LOADED = f"CASE l_linestatus WHEN 'F' THEN '{FIRST}' ELSE '{SECOND}' END AS partition, '{SECOND}' AS task_mark"


@register(f"""
WITH measures AS (
  SELECT *, 'part' AS measures_name, l_partkey AS amount, '4' AS digits FROM lineitem
  UNION ALL SELECT *, 'supplier', l_suppkey, '8' FROM lineitem),
both_levels AS (
  SELECT *, l_returnflag AS flags FROM measures UNION ALL SELECT *, l_linestatus FROM measures)
SELECT CAST(l_orderkey AS VARCHAR) AS key_order,
  CAST(l_linenumber AS VARCHAR) AS key_line_number, measures_name,
  CAST(amount AS VARCHAR) AS measures_value_amount, digits AS measures_value_digits, flags, {LOADED}
FROM both_levels""")
def task_run_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    tables = settings(spark, JSON_TASK, "files", flatten_mode="recursive", multi_line="false", partition_name="partition")
    documents = nested_lines(spark, sf_dir)
    for status, stamp in (("F", FIRST), ("O", SECOND)):
        load = documents.filter(of_load(F.col("flags")[0][1], status))
        land_text(load.select(F.to_json(F.struct("*"))), f"{root}/w/s/Files/source", stamp=stamp)
        run = rerun(spark, JSON_TASK, tables, root)
    return with_mark(read_table(spark, run.target, evolved=True), tables, JSON_TASK)


@register(f"""
WITH {LINES_SQL}
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_linestatus, {LOADED}
FROM raw_lines""")
def task_run_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    tables = settings(spark, PARQUET_TASK, "files", partition_name="partition")
    lines = raw_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_linestatus")
    for status, stamp in (("F", FIRST), ("O", SECOND)):
        land_rows(lines.filter(of_load("l_linestatus", status)), f"{root}/w/s/Files/source", stamp=stamp)
        run = rerun(spark, PARQUET_TASK, tables, root)
    return with_mark(read_table(spark, run.target, evolved=True), tables, PARQUET_TASK)


def silver_records(roles: SilverRoles) -> tuple[list[str], list[tuple]]:
    """The rows of a table of column roles."""
    names = ["expression", "column_type", "column_name", "column_order", "is_primary_key", "is_order_by", "is_output", "is_partition_by"]
    order = {c: n for n, c in enumerate(roles.order_by, 1)}
    parts = {c: n for n, c in enumerate(roles.partition_by, 1)}
    return names, [
        (c.expression, c.type, c.name, n, int(c.name in roles.primary_keys), order.get(c.name, 0), int(c.name in roles.outputs), parts.get(c.name, 0))
        for n, c in enumerate(roles.columns)
    ]


@register(f"""
WITH {LINES_SQL}, result AS (
  SELECT {LINES_OUT} FROM target ANTI JOIN updates USING (l_orderkey, l_linenumber)
  UNION ALL SELECT {LINES_OUT} FROM updates)
SELECT *, '{SECOND}' AS task_mark FROM result""")
def task_run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run takes the first stamp's rows again, for the mark is inclusive."""
    root = scratch_path(spark, "lake")
    tables = settings(spark, SILVER_TASK, "table", write_method="pk_merge", partition_update="false")
    tables[f"{SILVER_TASK}_schema"] = role_rows(spark, SILVER_TASK, *silver_records(line_roles()))
    lines = raw_lines(spark, sf_dir)
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in LINE_COLUMNS])
    # The mark's stamp comes again: it is empty but for what was there.
    for status, stamp in (("F", FIRST), ("O", SECOND)):
        load = text.filter(of_load("l_linestatus", status)).withColumn("partition", F.lit(stamp))
        append_evolve(load, f"{root}/w/s/Tables/dbo/source", ["partition"], rebalance=False)
        overrides = None if status == "F" else {"min_partition": SECOND}
        run = run_task(spark, f"{SILVER_TASK}:1", tables, root, overrides)
        tables[f"{SILVER_TASK}_dynamic"] = materialize(run.marks, "marks")
    found = portable(read_table(spark, run.target).select(*LINE_COLUMNS))
    return with_mark(found, tables, SILVER_TASK)


@register(f"""
WITH {DAILY_SQL}, {history_sql("daily", "versions")}, present AS (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS days FROM daily)
SELECT {HISTORY_OUT}, (SELECT CAST(max(dt) AS VARCHAR) FROM daily) AS task_mark FROM versions""")
def task_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build from metadata, then a run that finds no new day."""
    root = scratch_path(spark, "lake")
    tables = settings(spark, HISTORY_TASK, "table")
    flags = {
        "is_primary_key": "user_id", "is_business_key": "event_type", "is_date_key": "dt", "is_valid_from": "valid_from",
        "is_valid_to": "valid_to", "is_is_current": "is_current", "is_row_hash": "row_hash", "is_surrogate_key": "history_sk",
    }
    records = [(c, *[int(c == name) for name in flags.values()]) for c in flags.values()]
    tables[f"{HISTORY_TASK}_schema"] = role_rows(spark, HISTORY_TASK, ["column_name", *flags], records)
    daily_state(spark, sf_dir).write.partitionBy("dt").parquet(f"{root}/w/s/Tables/dbo/source")
    for _ in range(2):
        run = rerun(spark, HISTORY_TASK, tables, root)
    columns = ["user_id", "event_type", "dt", "row_hash", "valid_from", "valid_to", "is_current", "history_sk"]
    return with_mark(portable(read_table(spark, run.target).select(*columns)), tables, HISTORY_TASK)


@register("""
SELECT 'task_json_to_delta:' || doc_id AS task_id,
  'deltalake:w/s/tables/' || source || '/' || lang AS dataset_path FROM documents
UNION SELECT 'task_update_silver:' || l_suppkey, 'deltalake:w/s/tables/lines/' || l_returnflag FROM lineitem
UNION SELECT 'task_parquet_to_delta:' || p_partkey, 'deltalake:w/s/tables/parts/' || p_brand FROM part
UNION SELECT 'task_create_scd2:' || c_custkey, 'deltalake:w/s/tables/customers/' || c_mktsegment FROM customer
UNION SELECT 'task_identity_transfer:' || s_suppkey, 'deltalake:w/s/tables/suppliers/' || s_nationkey FROM supplier
UNION SELECT 'task_to_warehouse:' || o_custkey, 'warehouse:w/s/orders/' || o_orderstatus FROM orders
UNION SELECT 'task_pokemon_api:' || page_id, 'lakefiles:w/s/files/' || page_id FROM pages""")
def task_targets_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets over the tasks of all kinds."""

    def tasks(kind: str, name: str, key: str, path: str, last: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return df.select(
            F.concat(F.lit(f"{kind}:"), F.col(key)).alias("task_id"), F.concat(F.lit(path), F.col(last)).alias("target_path")
        )

    tables = {JSON_TASK: document_tasks(spark, sf_dir)} | {
        kind: tasks(kind, *rest)
        for kind, *rest in (
            (SILVER_TASK, "lineitem", "l_suppkey", "deltalake:w/s/tables/lines/", "l_returnflag"),
            (PARQUET_TASK, "part", "p_partkey", "deltalake:w/s/tables/parts/", "p_brand"),
            (HISTORY_TASK, "customer", "c_custkey", "deltalake:w/s/tables/customers/", "c_mktsegment"),
            ("task_identity_transfer", "supplier", "s_suppkey", "deltalake:w/s/tables/suppliers/", "s_nationkey"),
            ("task_to_warehouse", "orders", "o_custkey", "warehouse:w/s/orders/", "o_orderstatus"),
            ("task_pokemon_api", "pages", "page_id", "lakefiles:w/s/files/", "page_id"),
        )
    }
    return all_task_targets(tables)
