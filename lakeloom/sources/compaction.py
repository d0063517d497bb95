"""Small files put together, by the sizes that files have.

A partition is fragmented if several of its files are small.  Only such partitions are
rewritten: their files are put into bins of the wanted size, and each bin becomes a file.  The
rows of other partitions are not read, and their files stay what they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions import named
from lakeloom.operators.keys import number_rows
from lakeloom.shared import hadoop_path, materialize, scratch_tables, session_settings
from lakeloom.sources.files import laid_out
from lakeloom.sources.records import read_record, write_record

#: Bytes that a file should have; files of less than half are small.
FILE_BYTES = 128 << 20


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a table's folders are named after, outermost first."""
    fs, where = hadoop_path(spark, path)
    found: list[str] = []
    while True:
        inside = [s.getPath() for s in fs.listStatus(where) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inside:
            return found
        where = inside[0]
        found.append(where.getName().split("=", 1)[0])


def bins(df: DataFrame, partition_by: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """(partition columns, ``__file``, ``__bin``) of the files of fragmented partitions.

    Larger files come first, and a bin is closed once it has the wanted size.  Nothing but the
    sizes of files is read."""
    where = df.metadataColumn("_metadata")
    parts = [named(c) for c in partition_by]
    files = df.select(
        *parts, where["file_path"].alias("__file"), where["file_size"].alias("__size")
    ).distinct()
    every = Window.partitionBy(*parts)
    before = every.orderBy(F.desc("__size"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    small = F.count_if(F.col("__size") < file_bytes / 2).over(every)
    filled = F.coalesce(F.sum("__size").over(before), F.lit(0))
    found = files.select("*", small.alias("__small"), F.floor(filled / file_bytes).alias("__bin"))
    return found.where("__small > 1").drop("__size", "__small")


def compact_in_place(
    spark: SparkSession, path: str, fmt: str = "parquet", file_bytes: int = FILE_BYTES
) -> int:
    """Rewrite the fragmented partitions of a table (all of it, if it has no partitions and is
    fragmented); returns how many files were put together."""
    with scratch_tables(spark):
        parts = partition_columns(spark, path)
        table = laid_out(spark, path, fmt, evolved=True)
        chosen = materialize(bins(table, parts, file_bytes), "bins")
        files = chosen.count()
        if not files:
            return 0
        # Each bin has a number of its own, so that no task gets two of them.
        numbered = materialize(number_rows(chosen.drop("__file").distinct(), [*parts, "__bin"], "__n"), "bin-numbers")
        n = numbered.count()
        where = table.metadataColumn("_metadata")
        rows = table.withColumn("__path", where["file_path"])
        if parts:
            # Partitions are pruned before files are looked up.
            touched = chosen.select(*[named(c).alias(f"__{i}") for i, c in enumerate(parts)]).distinct()
            same = [named(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(parts)]
            rows = rows.join(touched, reduce(and_, same), "left_semi")
        alike = [F.col(f"c.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in [*parts, "__bin"]]
        numbers = chosen.alias("c").join(numbered.alias("b"), reduce(and_, alike)).select(F.col("__file").alias("__path"), "__n")
        rows = rows.join(numbers, "__path").repartitionById(n, F.col("__n").cast("int") - 1)
        rows = rows.select(*map(named, table.columns))
        if parts:
            writer = rows.write.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
            # A bin lies in one partition: its rows go to one file as they come, and Spark need
            # not sort them by partition, which would hold them all.
            with session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "1"}):
                writer.mode("overwrite").format(fmt).save(path)
        else:
            record = read_record(spark, path)
            rows = materialize(rows, "compact").coalesce(n)
            rows.write.mode("overwrite").format(fmt).save(path)
            if record:
                write_record(spark, path, **record)
    spark.catalog.refreshByPath(path)
    return files
