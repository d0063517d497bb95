"""Landing: append documents or rows as they are, stamped with the extraction time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.constants import STAMP_FORMAT


def extraction_stamp(stamp: str | Column | None = None, stamp_format: str = STAMP_FORMAT) -> Column:
    """A fixed stamp, a timestamp column to format, or the time of the run."""
    if isinstance(stamp, str):
        return F.lit(stamp)
    return F.date_format(F.current_timestamp() if stamp is None else stamp, stamp_format)


#: Codec of landed text, and lines of a file: such files cannot be split by their readers.
TEXT_CODEC, TEXT_LINES = "lz4", 500_000


def _append(
    df: DataFrame, path: str, partition: str, fmt: str, many_stamps: bool, **options: object
) -> None:
    # With one stamp every task writes one file and no shuffle is needed.  Rows that carry
    # their own stamps are rebalanced: few, evenly sized files per stamp, big stamps split.
    if many_stamps:
        df = df.hint("rebalance", F.col(partition))
    df.write.mode("append").partitionBy(partition).format(fmt).options(**options).save(path)


def land_text(
    df: DataFrame,
    path: str,
    partition: str = "partition",
    stamp: str | Column | None = None,
    stamp_format: str = STAMP_FORMAT,
) -> None:
    """Append documents, one per line.  ``df`` has the document text as its first column.  Files
    are compressed: keys of JSON documents repeat in every line."""
    text = F.col(df.columns[0]).cast("string").alias("value")
    _append(
        df.select(text, extraction_stamp(stamp, stamp_format).alias(partition)),
        path,
        partition,
        "text",
        many_stamps=isinstance(stamp, Column),
        compression=TEXT_CODEC,
        maxRecordsPerFile=TEXT_LINES,
    )


def land_rows(
    df: DataFrame,
    path: str,
    partition: str = "partition",
    stamp: str | Column | None = None,
    stamp_format: str = STAMP_FORMAT,
    fmt: str = "parquet",
) -> None:
    """Append rows."""
    stamped = df.withColumn(partition, extraction_stamp(stamp, stamp_format))
    _append(stamped, path, partition, fmt, many_stamps=isinstance(stamp, Column))
