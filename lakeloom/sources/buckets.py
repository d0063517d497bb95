"""Tables laid out in buckets of their keys, so that a change rewrites what its keys fall into.

A bucket is a partition: its number is a hash of the key modulo the number of buckets, a power
of two, and its label holds both.  Rows with one key lie in one bucket, whatever else the table
is partitioned by, so a merge reads and replaces only the buckets that its rows have keys in.
The layout column is left out by ``read_table``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import named
from lakeloom.shared import hadoop_path
from lakeloom.sources.records import read_record

BUCKET = "key_bucket"
#: Bytes that a bucket should have, and the least number of buckets.
BUCKET_BYTES, LEAST = 256 << 20, 4


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, where = hadoop_path(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def bucket_count(size: int) -> int:
    """Buckets for a table of so many bytes."""
    n = LEAST
    while n * BUCKET_BYTES < size:
        n *= 2
    return n


def bucket(df: DataFrame, keys: Sequence[str], n: int) -> Column:
    """The label of each row's bucket; the keys count with the types that ``df`` gives them."""
    number = F.pmod(F.xxhash64(*map(named, keys)), F.lit(n)).cast("string")
    return F.concat(F.lpad(number, 6, "0"), F.lit(f"-of-{n}"))


def with_bucket(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket(df, keys, n))


def key_types(df: DataFrame, keys: Sequence[str]) -> list[list[str]]:
    """What the record holds of the keys: a hash depends on their order and types."""
    return [[k, df.schema[k].dataType.simpleString()] for k in keys]


def buckets_of(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str]) -> int | None:
    """The number of buckets of a table whose layout fits the keys of ``df``, else None."""
    record = read_record(spark, path)
    if record.get("bucket_keys") != key_types(df, keys):
        return None
    return record.get("buckets")


def labels(df: DataFrame) -> list[str]:
    """The labels that come in ``df``: at most as many as there are buckets."""
    return [r[0] for r in df.select(BUCKET).distinct().collect()]


def in_buckets(df: DataFrame, chosen: Iterable[str]) -> DataFrame:
    """The rows in some buckets; other folders are not read."""
    return df.where(F.col(BUCKET).isin(list(chosen)))


def leaf_files(spark: SparkSession, path: str, pattern: str) -> dict[str, set[str]]:
    """The data files by leaf folder, of folders whose path below the table's has a match."""
    fs, where = hadoop_path(spark, path)
    root, found = fs.makeQualified(where).toString(), {}
    level, matching = [(where, "")], re.compile(pattern)
    while level:
        folder, below = level.pop()
        for status in fs.listStatus(folder):
            at = status.getPath()
            name = at.getName()
            if status.isDirectory():
                if "=" in name:
                    level.append((at, f"{below}/{name}"))
            elif not name.startswith((".", "_")) and matching.search(below):
                found.setdefault(f"{root}{below}", set()).add(name)
    return found


def remove_unchanged(spark: SparkSession, before: dict[str, set[str]], pattern: str, path: str) -> list[str]:
    """Remove the leaf folders that a change should have replaced and that still hold what they
    held ``before``: nothing is left of their rows."""
    after = leaf_files(spark, path, pattern)
    gone = [leaf for leaf, files in before.items() if after.get(leaf) == files]
    for leaf in gone:
        fs, where = hadoop_path(spark, leaf)
        fs.delete(where, True)
    return gone
