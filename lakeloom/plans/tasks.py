"""One run of a task, from its metadata rows to its new mark.

A task's id begins with its kind.  Its settings, its mark and the roles of its columns are rows
of metadata tables named after the kind; its logical paths become places below a root folder.
What runs when is a scheduler's business.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeloom.constants import (
    HISTORY_TASK,
    IDENTITY_TASK,
    JSON_TASK,
    MARKS,
    PARQUET_TASK,
    SILVER_TASK,
    TARGET_TABLES,
)
from lakeloom.functions.paths import physical_path, split_paths
from lakeloom.operators.marks import upsert_marks
from lakeloom.operators.metadata import lookup_all, resolve_params, task_targets
from lakeloom.plans import bronze, gold, silver
from lakeloom.roles import HistoryRoles, SilverRoles
from lakeloom.sources.sinks import copy_table

Tables = Mapping[str, DataFrame]


class TaskRun(NamedTuple):
    mark: Any
    target: str
    marks: DataFrame | None  # the task kind's marks after the run, for the caller to store


def all_task_targets(tables: Tables) -> DataFrame:
    """The dataset each task writes, over the tables of all kinds that write one."""
    return task_targets([tables[name] for name in TARGET_TABLES if name in tables])


def _kind(task_id: str) -> str:
    kind, colon, _ = task_id.partition(":")
    if not colon:
        raise ValueError(f"Task {task_id!r} has no kind.")
    return kind


def task_settings(
    spark: SparkSession,
    task_id: str,
    tables: Tables,
    root: str,
    overrides: Mapping[str, Any] | None = None,
) -> Row:
    """The settings of a task in one row: stored values or a run's own ones, the mark (NULL if
    it never ran), and ``source`` and ``target``, the places of its logical paths."""
    kind = _kind(task_id)
    if kind not in tables:
        raise ValueError(f"There is no table of {kind!r} tasks.")
    static = lookup_all(tables[kind], task_id)
    mark = MARKS.get(kind)
    if mark is None:
        dynamic = static.select("task_id").limit(0)
    else:
        dynamic = tables[f"{kind}_dynamic"].select("task_id", mark)
    found = resolve_params(static, lookup_all(dynamic, task_id), overrides)
    for name in ("source", "target"):
        parts = split_paths(found.select(f"{name}_path"), f"{name}_path")
        place = F.concat_ws(
            "/", F.lit(root.rstrip("/")), "workspace", "store", physical_path("relative")
        )
        located = parts.select(
            f"{name}_path", F.when(F.col("path_status") == "ok", place).alias(name)
        )
        found = found.join(located.distinct(), f"{name}_path", "left")
    rows = found.limit(1).collect()
    if not rows:
        raise ValueError(f"No task {task_id!r}.")
    if rows[0].source is None or rows[0].target is None:
        raise ValueError(f"Task {task_id!r} has paths that have no place.")
    return rows[0]


def run_task(
    spark: SparkSession,
    task_id: str,
    tables: Tables,
    root: str,
    overrides: Mapping[str, Any] | None = None,
) -> TaskRun:
    """Run a task.  ``tables`` are the metadata tables by name; ``overrides`` are parameters of
    this run that stand in for stored ones.

    A run that finds nothing keeps the old mark.  A failed run leaves the marks alone, so it
    can simply be repeated: every plan replaces what it has half written."""
    kind, row = _kind(task_id), task_settings(spark, task_id, tables, root, overrides)
    given, column = row.asDict(), MARKS.get(kind)
    mark = given.get(column) if column else None
    partition = given.get("partition_name") or "partition"

    def records(name: str) -> list[dict[str, Any]]:
        # Tens of rows: the columns of one table.
        found = lookup_all(tables[name], task_id).collect()
        return [{k: v for k, v in r.asDict().items() if k != "task_id"} for r in found]

    match kind:
        case k if k == JSON_TASK:
            mode = given.get("flatten_mode") or "recursive"
            mark = bronze.update_from_json(
                spark, row.source, row.target, partition, mark, mode,
                records(f"{kind}_flatten") if mode == "column" else (),
                given.get("multi_line"), given.get("full_refresh"),
            )
        case k if k == PARQUET_TASK:
            mark = bronze.update_from_parquet(
                spark, row.source, row.target, partition, mark, given.get("full_refresh")
            )
        case k if k == SILVER_TASK:
            mark = silver.update_silver(
                spark, row.source, row.target, SilverRoles.parse(records(f"{kind}_schema")),
                given.get("write_method"), partition, mark,
                partitions_immutable=given.get("partition_update"),
                full_refresh=given.get("full_refresh"),
            )
        case k if k == HISTORY_TASK:
            mark = gold.update_history_table(
                spark, row.source, row.target, HistoryRoles.parse(records(f"{kind}_schema")),
                mark, given.get("full_refresh"),
            )
        case k if k == IDENTITY_TASK:
            copy_table(spark, row.source, row.target)
        case _:
            raise ValueError(f"Tasks of kind {kind!r} do not run here.")
    if column is None:
        return TaskRun(None, row.target, None)
    held = tables[f"{kind}_dynamic"].select("task_id", column)
    new = spark.createDataFrame([(task_id, None if mark is None else str(mark))], "task_id string, mark string")
    new = new.select("task_id", F.col("mark").cast(held.schema[column].dataType).alias(column))
    return TaskRun(mark, row.target, upsert_marks(held, new, column))
