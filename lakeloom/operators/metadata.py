"""Queries over the metadata tables: settings, parameters, jobs and targets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import named


def lookup_all(table: DataFrame, tasks: str | DataFrame) -> DataFrame:
    """All settings of a task, or of every task in a frame of ``task_id`` in one join."""
    if isinstance(tasks, str):
        return table.filter(F.col("task_id") == tasks)
    return table.join(tasks.select("task_id"), "task_id", "left_semi").select(
        *map(named, table.columns)
    )


def lookup_one(table: DataFrame, tasks: str | DataFrame) -> DataFrame:
    """One settings row per task: of several, the first in column order."""
    first = Window.partitionBy("task_id").orderBy(*map(named, table.columns))
    found = lookup_all(table, tasks).withColumn("__row", F.row_number().over(first))
    return found.filter("__row = 1").drop("__row")


def resolve_params(
    static: DataFrame, dynamic: DataFrame, overrides: Mapping[str, Any] | None = None
) -> DataFrame:
    """The parameters of every task: a run's own value, else the stored one.  The mark is
    NULL for tasks that never ran; of several rows of a task the first in column order counts,
    stored or dynamic."""
    firsts = lookup_one(dynamic, static)
    joined = lookup_one(static, static).join(firsts, "task_id", "left")
    given = {k: v for k, v in (overrides or {}).items() if v is not None}
    unknown = sorted(set(given) - set(joined.columns))
    if unknown:
        raise ValueError(f"No such parameters: {unknown}.")
    return joined.withColumns(
        {k: F.lit(v).cast(joined.schema[k].dataType) for k, v in given.items()}
    )


def task_targets(task_tables: Iterable[DataFrame]) -> DataFrame:
    """The dataset each task writes, over all task tables."""
    parts = [t.select("task_id", F.col("target_path").alias("dataset_path")) for t in task_tables]
    return reduce(DataFrame.unionByName, parts).distinct()


def task_prefix(task_id: str = "task_id") -> Column:
    """The kind of a task: its id up to the colon, NULL without one."""
    return F.when(F.col(task_id).contains(":"), F.substring_index(task_id, ":", 1))


def job_tasks(jobs: DataFrame, job_id: int, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The task ids selected by a job's own SQL text, run over the given metadata tables."""
    found = jobs.filter(F.col("job_id") == job_id).orderBy("task_sql").limit(1).collect()
    if not found:
        raise ValueError(f"No job {job_id}.")
    # The text sees just these tables; views of the caller are neither used nor replaced.
    spark, own = jobs.sparkSession, {name: f"job_{uuid4().hex}" for name in tables}
    for name, table in tables.items():
        table.createOrReplaceTempView(own[name])
    views = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in own.items())
    try:
        selected = spark.sql(f"WITH {views} SELECT * FROM ({found[0].task_sql})")
    finally:
        for view in own.values():
            spark.catalog.dropTempView(view)
    return selected.toDF("task_id").distinct()
