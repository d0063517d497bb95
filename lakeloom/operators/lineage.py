"""Task order from dataset lineage.

The level of a task is the length of its longest chain of parents.  A task with one parent has
the level after it, so unbranched chains are contracted first: each such task learns its nearest
ancestor that has no parent or several, and how far it is, by jumps that grow fourfold a step.
What is left are tasks with several parents; each step joins those reached last with the edges
to them.  An edge is settled once, and steps only add to what earlier ones have written; their
number falls with the depth of branching, not with the longest chain.  The tasks of a step never
come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.metadata import task_prefix
from lakeloom.shared import materialize, scratch_path


def lineage_edges(tasks: DataFrame, targets: DataFrame, lineage: DataFrame) -> DataFrame:
    """(task_id, parent_id) for the given tasks.  A parent outside them is NULL."""
    datasets = tasks.select("task_id").join(targets, "task_id", "left")
    parents = datasets.select(
        F.col("task_id").alias("parent_id"), F.col("dataset_path").alias("parent_path")
    )
    return (
        datasets.join(lineage, "dataset_path", "left")
        .join(parents, "parent_path", "left")
        .select("task_id", "parent_id")
    )


def _twice(jumps: DataFrame) -> DataFrame:
    """Each jump followed by that of where it ends, if there is one (``moved``)."""
    then = jumps.select(
        F.col("task_id").alias("up"), F.col("up").alias("__up"), F.col("dist").alias("__dist")
    )
    return jumps.join(then, "up", "left").select(
        "task_id",
        F.coalesce("__up", "up").alias("up"),
        (F.col("dist") + F.coalesce("__dist", F.lit(0))).alias("dist"),
        F.col("__up").isNotNull().alias("moved"),
    )


def contracted(parents: DataFrame) -> DataFrame:
    """(task_id, up, dist) of the tasks that have one parent: ``up`` is the nearest ancestor
    that has none or several, ``dist`` steps above.  Tasks on a ring of such tasks, and those
    behind them, end in the ring.  ``parents`` has a row per task and parent."""
    single = parents.groupBy("task_id").agg(F.count("*").alias("n"), F.min("parent_id").alias("up"))
    jumps = single.where("n = 1").select("task_id", "up", F.lit(1).cast("bigint").alias("dist"))
    jumps = materialize(jumps, "jumps")
    length, tasks = 1, jumps.count()
    # No chain is longer than there are tasks: what still moves then goes round.
    while length <= tasks:
        for _ in range(2):
            jumps, length = _twice(jumps), length * 2
        jumps = materialize(jumps, "jumps")
        if jumps.where("moved").isEmpty():
            break
    return jumps.select("task_id", "up", "dist")


def lineage_levels(edges: DataFrame) -> DataFrame:
    """(task_id, pipeline_id, batch_num, task_status) of every task.

    Tasks in cycles, and those behind them, have no level and the status ``cycle``; ids without
    a kind have the status ``no prefix``."""
    spark = edges.sparkSession
    edges = materialize(edges, "edges")
    parents = materialize(edges.filter(F.col("parent_id").isNotNull()).distinct(), "parents")
    jumps = contracted(parents)
    # Edges of tasks with several parents, each to the end of its parent's chain.
    ends = jumps.select(F.col("task_id").alias("parent_id"), "up", "dist")
    several = parents.join(jumps.select("task_id"), "task_id", "left_anti")
    several = several.join(ends, "parent_id", "left").select(
        "task_id",
        F.coalesce("up", "parent_id").alias("root"),
        (F.coalesce("dist", F.lit(0)) + 1).alias("w"),
    )
    several = several.groupBy("task_id", "root").agg(F.max("w").alias("w"))
    several = materialize(several, "branches")
    needs = materialize(several.groupBy("task_id").agg(F.count("*").alias("n")), "needs")

    reached_path, held_path = scratch_path(spark, "levels"), scratch_path(spark, "settled")
    level_schema = "task_id string, level bigint"

    def save(tasks: DataFrame, step: int) -> DataFrame:
        tasks.write.parquet(f"{reached_path}/step={step}")
        return spark.read.schema(level_schema).parquet(f"{reached_path}/step={step}")

    tops = edges.select("task_id").distinct().join(parents.select("task_id"), "task_id", "left_anti")
    step, reached = 0, save(tops.select("task_id", F.lit(1).cast("bigint").alias("level")), 0)
    while not several.isEmpty() and not reached.isEmpty():
        step += 1
        settled = several.join(reached.withColumnRenamed("task_id", "root"), "root")
        settled = settled.select("task_id", (F.col("level") + F.col("w")).alias("level"))
        settled.write.parquet(f"{held_path}/step={step}")
        new = spark.read.schema(level_schema).parquet(f"{held_path}/step={step}")
        every = spark.read.schema(level_schema).parquet(held_path).select("task_id", "level")
        # Tasks all of whose edges are settled, this step the last of them.
        met = every.join(new.select("task_id").distinct(), "task_id", "left_semi")
        met = met.groupBy("task_id").agg(F.count("*").alias("met"), F.max("level").alias("level"))
        freed = met.join(needs, "task_id").where("met = n").select("task_id", "level")
        reached = save(freed, step)

    known = spark.read.schema(level_schema).parquet(reached_path).select("task_id", "level")
    along = jumps.join(known.withColumnRenamed("task_id", "up"), "up")
    along = along.select("task_id", (F.col("level") + F.col("dist")).alias("level"))
    found = known.unionByName(along).withColumn("batch_num", F.col("level").cast("int"))
    status = (
        F.when(F.col("batch_num").isNull(), "cycle")
        .when(F.col("pipeline_id").isNull(), "no prefix")
        .otherwise("ok")
    )
    return (
        edges.select("task_id")
        .distinct()
        .join(found.drop("level"), "task_id", "left")
        .withColumn("pipeline_id", task_prefix())
        .withColumn("task_status", status)
        .select("task_id", "pipeline_id", "batch_num", "task_status")
    )


def level_tasks(levels: DataFrame, batch_num: int) -> DataFrame:
    """The tasks of one level, ready to run together."""
    return levels.filter(F.col("batch_num") == batch_num).select(
        "task_id", "pipeline_id", "batch_num"
    )
