"""From a job to its ordered tasks: one set of rows, no scheduler."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from lakeloom.operators.lineage import level_tasks, lineage_edges, lineage_levels
from lakeloom.operators.metadata import job_tasks, task_targets


def job_levels(
    jobs: DataFrame,
    job_id: int,
    tables: Mapping[str, DataFrame],
    task_tables: Iterable[DataFrame],
    lineage: DataFrame,
) -> DataFrame:
    """Every task of a job with its level.  ``tables`` are the metadata tables that the job's
    SQL may name, ``task_tables`` those that say which dataset a task writes."""
    tasks = job_tasks(jobs, job_id, tables)
    return lineage_levels(lineage_edges(tasks, task_targets(task_tables), lineage))


def job_batch(levels: DataFrame, batch_num: int) -> DataFrame:
    """The tasks of a job that may run together after those of the levels before."""
    return level_tasks(levels, batch_num)
