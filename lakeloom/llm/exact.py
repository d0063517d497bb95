"""Exact deduplication with keyed streaming state.

Arrivals (digest, id, where the content lies) run through a stateful stream whose state lies
in RocksDB on the executors' disks and in the checkpoint in the shared folder.  The state has
one entry a digest, never expires, and holds the entry to keep and the number of arrivals, so
later runs with the same checkpoint go on from it.  Where a digest is hit again, the contents
are fetched by their places and compared byte by byte.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import located, small
from lakeloom.shared import materialize, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normal(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null is the empty text."""
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB, which is told not to allocate files ahead: with many partitions that
    takes megabytes for each, however few rows it has."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    old = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def ingest(arrivals: DataFrame, checkpoint: str) -> DataFrame:
    """Run the streaming frame ``arrivals`` (digest, doc_id, file, at) into the state, and
    return the state: ``digest``, ``keep`` (the entry with the largest doc_id, null smallest,
    then the largest place) and ``n``."""
    spark = arrivals.sparkSession
    entry = F.struct("doc_id", "file", "at")
    state = arrivals.groupBy("digest").agg(F.max(entry).alias("keep"), F.count("*").alias("n"))
    with _state_on_disk(spark):
        run = (
            state.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
        first, second = kept.schema["value"].dataType.fieldNames()
        return kept.select(
            F.col("key")[kept.schema["key"].dataType.fieldNames()[0]].alias("digest"),
            F.col("value")[first].alias("keep"),
            F.col("value")[second].alias("n"),
        )


def dedup(docs: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (hex
    SHA-256 of the normalised text) and its place (``file``, ``at``).

    Equal texts are one group, empty and null ones too; of repeated rows with one id exactly
    one is kept.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "arrivals")
    at = located(docs)
    at.select(
        F.sha2(normal(F.col("row.text")), 256).alias("digest"),
        F.col("row.doc_id").alias("doc_id"),
        "file",
        "at",
    ).write.parquet(path)
    arrivals = spark.read.parquet(path)
    stream = spark.readStream.schema(arrivals.schema).parquet(path)
    state = ingest(stream, checkpoint or scratch_path(spark, "dedup-state"))
    groups = materialize(state.where("n > 1"), "dedup-groups")
    groups = _verified(at, arrivals, groups)
    joined = arrivals.join(small(groups), "digest", "left")
    if "part" in groups.columns:
        joined = arrivals.join(groups, ["digest", "file", "at"], "left")
    found = F.col("keep").isNotNull()
    return joined.select(
        "doc_id",
        F.when(found, F.col("keep.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(found, F.col("n")).otherwise(F.lit(1)).cast("bigint").alias("group_size"),
        (~found | ((F.col("keep.file") == F.col("file")) & (F.col("keep.at") == F.col("at")))).alias("kept"),
        "digest",
        "file",
        "at",
    )


def _verified(at: DataFrame, arrivals: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups`` if all texts of each are equal in every byte; else the groups, by text, of
    each row (digest, file, at) whose digest is shared by different texts."""
    hits = materialize(
        arrivals.join(small(groups), "digest").select("digest", "file", "at", "keep"), "dedup-hits"
    )
    if hits.isEmpty():
        return groups
    texts = at.select("file", "at", normal(F.col("row.text")).alias("text")).join(
        small(hits), ["file", "at"]
    )
    is_kept = (F.col("keep.file") == F.col("file")) & (F.col("keep.at") == F.col("at"))
    kept = texts.where(is_kept).select("digest", F.col("text").alias("kept_text"))
    differ = materialize(
        texts.join(kept, "digest").where("text <> kept_text").select("digest").distinct(), "dedup-differ"
    )
    if differ.isEmpty():
        return groups
    entry = F.struct("doc_id", "file", "at")
    ids = arrivals.select("doc_id", "file", "at")
    mixed = texts.join(small(differ), "digest", "left_semi").join(ids, ["file", "at"])
    by_text = mixed.groupBy("digest", "text").agg(F.max(entry).alias("keep"), F.count("*").alias("n"))
    apart = mixed.join(by_text, ["digest", "text"]).select("digest", "file", "at", F.col("keep"), "n")
    plain = hits.join(small(differ), "digest", "left_anti").select("digest", "file", "at")
    plain = plain.join(groups, "digest").select("digest", "file", "at", "keep", "n")
    return materialize(plain.unionByName(apart).withColumn("part", F.lit(True)), "dedup-parts")
