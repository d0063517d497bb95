"""Metadata queries.  The metadata tables are derived from the given ones: each conversation
turn is a task whose dataset depends on the datasets of the two turns before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.constants import JOBS_SCHEMA
from lakeloom.functions import paths
from lakeloom.operators import lineage, marks, metadata
from lakeloom.plans import control
from lakeloom.queries import register
from lakeloom.queries.inputs import table


def control_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("role") == "user", "task_json_to_delta")
        .when(F.col("role") == "assistant", "task_update_silver")
        .otherwise("task_create_scd2")
    )
    return table(spark, sf_dir, "conversations").select(
        F.concat(kind, F.lit(":"), "conv_id", F.lit("/"), "turn").alias("task_id"),
        (F.col("role") != "system").alias("is_active"),
        F.col("role").alias("stage_name"),
        F.concat(F.lit("conversation "), "conv_id").alias("lineage_name"),
        F.concat(F.lit("deltalake:w/s/tables/c"), "conv_id", F.lit("/t"), "turn").alias(
            "target_path"
        ),
    )


def dataset_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    path = "concat('deltalake:w/s/tables/c', conv_id, '/t', {})"
    return turns.select(
        F.expr(path.format("turn")).alias("dataset_path"), "conv_id", F.col("turn")
    ).select(
        "dataset_path",
        F.explode(
            F.array(F.expr(path.format("turn - 1")), F.expr(path.format("turn - 2")))
        ).alias("parent_path"),
    )


TASKS_SQL = """
tasks AS (
  SELECT conv_id, turn, role, CASE role WHEN 'user' THEN 'task_json_to_delta'
    WHEN 'assistant' THEN 'task_update_silver' ELSE 'task_create_scd2' END
    || ':' || conv_id || '/' || turn AS task_id
  FROM conversations),
chosen AS (SELECT * FROM tasks WHERE role <> 'system'),
edges AS (
  SELECT c.task_id, p.task_id AS parent_id
  FROM tasks AS c CROSS JOIN (VALUES (1), (2)) AS back(n)
  LEFT JOIN tasks AS p ON p.conv_id = c.conv_id AND p.turn = c.turn - n)"""


def control_jobs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            (1, "active_tasks", "select task_id from control_tasks where is_active"),
            (2, "user_tasks", "select task_id from control_tasks where stage_name = 'user'"),
            (3, "all_tasks", "select task_id from control_tasks"),
        ],
        JOBS_SCHEMA,
    )


def chosen_tasks(spark: SparkSession, sf_dir: str, job_id: int) -> DataFrame:
    tables = {"control_tasks": control_tasks(spark, sf_dir)}
    return metadata.job_tasks(control_jobs(spark), job_id, tables)


@register(f"WITH {TASKS_SQL} SELECT task_id FROM chosen")
def job_task_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_tasks(spark, sf_dir, 1)


@register(f"WITH {TASKS_SQL} SELECT task_id, parent_id FROM edges")
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = metadata.task_targets([control_tasks(spark, sf_dir)])
    return lineage.lineage_edges(
        chosen_tasks(spark, sf_dir, 3), targets, dataset_lineage(spark, sf_dir)
    )


@register(f"""
WITH RECURSIVE {TASKS_SQL},
levels AS (
  SELECT task_id, 1 AS n FROM edges WHERE parent_id IS NULL
  UNION SELECT edges.task_id, n + 1 FROM edges JOIN levels ON parent_id = levels.task_id)
SELECT task_id, split_part(task_id, ':', 1) AS pipeline_id,
  CAST(max(n) AS BIGINT) AS batch_num, 'ok' AS task_status
FROM levels GROUP BY task_id""")
def lineage_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = control_tasks(spark, sf_dir)
    levels = control.job_levels(
        control_jobs(spark), 3, {"control_tasks": tasks}, [tasks], dataset_lineage(spark, sf_dir)
    )
    return levels.withColumn("batch_num", F.col("batch_num").cast("bigint"))


def document_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loading task per document."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("task_json_to_delta:"), "doc_id").alias("task_id"),
        F.concat(F.lit("deltalake:w/s/tables/"), "source", F.lit("/"), "lang").alias("target_path"),
        F.lit("recursive").alias("flatten_mode"),
        F.lit("false").alias("full_refresh"),
    )


def document_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks of the tasks that ran: those of labelled documents."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("task_json_to_delta:"), "doc_id").alias("task_id"),
        F.concat(F.lit("2025010"), F.col("quality") + 1, F.lit("000000")).alias("min_partition"),
    )


def flatten_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings of a task per conversation, one for each turn."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("task_json_to_delta:"), "conv_id").alias("task_id"),
        F.col("turn").alias("depth"),
        F.col("role").alias("column"),
    )


def guided_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks to look up: conversations with a system turn."""
    return flatten_settings(spark, sf_dir).filter(F.col("column") == "system").select("task_id")


SETTINGS_SQL = """
settings AS (
  SELECT 'task_json_to_delta:' || conv_id AS task_id, turn AS depth, role AS "column"
  FROM conversations),
wanted AS (SELECT task_id FROM settings WHERE "column" = 'system')"""


@register(f"""
WITH {SETTINGS_SQL}
SELECT * FROM settings WHERE task_id IN (SELECT task_id FROM wanted)
QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY depth, "column") = 1""")
def metadata_lookup_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.lookup_one(flatten_settings(spark, sf_dir), guided_tasks(spark, sf_dir))


@register(f"""
WITH {SETTINGS_SQL}
SELECT * FROM settings WHERE task_id IN (SELECT task_id FROM wanted)""")
def metadata_lookup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.lookup_all(flatten_settings(spark, sf_dir), guided_tasks(spark, sf_dir))


@register("""
SELECT 'task_json_to_delta:' || doc_id AS task_id,
  'deltalake:w/s/tables/' || source || '/' || lang AS target_path,
  'recursive' AS flatten_mode, 'true' AS full_refresh,
  '2025010' || (quality + 1) || '000000' AS min_partition
FROM documents LEFT JOIN labels USING (doc_id)""")
def resolve_task_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    static, dynamic = document_tasks(spark, sf_dir), document_marks(spark, sf_dir)
    return metadata.resolve_params(static, dynamic, {"full_refresh": "true", "flatten_mode": None})


@register("""
SELECT 'task_json_to_delta:' || doc_id AS task_id,
  'deltalake:w/s/tables/' || source || '/' || lang AS dataset_path FROM documents
UNION SELECT 'task_update_silver:' || l_suppkey, 'deltalake:w/s/tables/lines/' || l_returnflag
FROM lineitem""")
def task_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_tasks = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("task_update_silver:"), "l_suppkey").alias("task_id"),
        F.concat(F.lit("deltalake:w/s/tables/lines/"), "l_returnflag").alias("target_path"),
    )
    return metadata.task_targets([document_tasks(spark, sf_dir), line_tasks])


@register("""
SELECT url AS task_id, split_part(url, ':', 1) AS pipeline_id FROM pages
UNION ALL SELECT source, NULL FROM documents""")
def task_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "pages").select(F.col("url").alias("task_id"))
    plain = table(spark, sf_dir, "documents").select(F.col("source").alias("task_id"))
    return ids.unionByName(plain).withColumn("pipeline_id", metadata.task_prefix())


@register("""
SELECT 'task_json_to_delta:' || doc_id AS task_id,
  coalesce(CASE WHEN lang = 'en' THEN '20250301000000' END,
           '2025010' || (quality + 1) || '000000') AS min_partition
FROM documents LEFT JOIN labels USING (doc_id)""")
def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tasks ran again; those of documents in other languages found nothing."""
    updates = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("task_json_to_delta:"), "doc_id").alias("task_id"),
        F.when(F.col("lang") == "en", "20250301000000").alias("min_partition"),
    )
    return marks.upsert_marks(document_marks(spark, sf_dir), updates, "min_partition")


def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path per document; its language decides the type."""
    kind = (
        F.when(F.col("lang") == "en", "deltalake:w/{s}/tables/{l}/d{d}")
        .when(F.col("lang") == "fr", "LakeFiles:w/{s}/files/{l}/d{d}")
        .when(F.col("lang") == "de", "warehouse:w/{s}/{l}/d{d}")
        .otherwise("eventhouse:w/{s}/{l}/d{d}")
    )
    filled = F.replace(kind, F.lit("{s}"), F.col("source"))
    filled = F.replace(filled, F.lit("{l}"), F.col("lang"))
    filled = F.replace(filled, F.lit("{d}"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", filled.alias("dataset_path"))


PATHS_SQL = """
paths AS (
  SELECT doc_id, lang, source,
    CASE lang WHEN 'en' THEN 'deltalake:w/' || source || '/tables/' || lang || '/d' || doc_id
      WHEN 'fr' THEN 'LakeFiles:w/' || source || '/files/' || lang || '/d' || doc_id
      WHEN 'de' THEN 'warehouse:w/' || source || '/' || lang || '/d' || doc_id
      ELSE 'eventhouse:w/' || source || '/' || lang || '/d' || doc_id END AS dataset_path
  FROM documents)"""


@register(f"""
WITH {PATHS_SQL}
SELECT doc_id, dataset_path, lower(split_part(dataset_path, ':', 1)) AS path_type,
  CASE WHEN lang IN ('en', 'fr', 'de') THEN 'w' END AS workspace,
  CASE WHEN lang IN ('en', 'fr', 'de') THEN source END AS store,
  CASE lang WHEN 'en' THEN 'tables' WHEN 'fr' THEN 'files' END AS area,
  CASE WHEN lang IN ('en', 'de') THEN lang END AS schema_name,
  CASE WHEN lang IN ('en', 'de') THEN 'd' || doc_id END AS table_name,
  CASE WHEN lang = 'fr' THEN lang || '/d' || doc_id END AS directory,
  CASE WHEN lang IN ('en', 'fr', 'de') THEN 'ok' ELSE 'not implemented' END AS path_status
FROM paths""")
def split_dataset_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths.split_paths(document_paths(spark, sf_dir), "dataset_path")


@register(f"""
WITH {PATHS_SQL}
SELECT doc_id,
  CASE lang WHEN 'en' THEN source || '.en.d' || doc_id
    WHEN 'fr' THEN '/lakehouse/default/Files/fr/d' || doc_id END AS api,
  CASE lang WHEN 'en' THEN source || '.d' || doc_id END AS catalog,
  CASE lang WHEN 'en' THEN 'Tables/en/d' || doc_id WHEN 'fr' THEN 'Files/fr/d' || doc_id END
    AS relative,
  CASE lang WHEN 'en' THEN 'abfss://w@lake.example/' || source || '.Lakehouse/Tables/en/d' || doc_id
    WHEN 'fr' THEN 'abfss://w@lake.example/' || source || '.Lakehouse/Files/fr/d' || doc_id END
    AS abfss
FROM paths""")
def physical_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = paths.split_paths(document_paths(spark, sf_dir), "dataset_path")
    forms = ["api", "catalog", "relative", "abfss"]
    return parts.select(
        "doc_id", *[paths.physical_path(form, "lake.example").alias(form) for form in forms]
    )
