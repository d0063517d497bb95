"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.shared import materialize

#: Rows up to which a counted table of narrow rows may be broadcast.
BROADCAST_ROWS = 300_000

#: White space of the word counts: space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, as ``--py-files`` would: their Python workers
    need not have it on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    path = f"{tempfile.mkdtemp(prefix='lakeloom-')}/lakeloom.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((root / "lakeloom").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def arrow_udf(kind):
    """``F.arrow_udf`` for functions of this package."""
    ship(SparkSession.getActiveSession())
    return F.arrow_udf(kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(df: DataFrame) -> DataFrame:
    """Columns ``row`` (all of ``df`` as one struct), ``file`` and ``at``: where the row lies.

    File and position are the same in every reading of the same files, after lost executors
    too, so they tell apart rows that agree in every column.  A frame that is not a plain scan
    is written to the shared folder first.  ``file`` is a 64-bit hash of the path.
    """
    df = scanned(df)
    where = df.metadataColumn("_metadata")
    return df.select(
        F.struct("*").alias("row"),
        F.xxhash64(where["file_path"]).alias("file"),
        where["row_index"].alias("at"),
    )


def scanned(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain scan, else a scan of it as written to the shared folder: what
    asks twice where its rows lie must ask one writing of it."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return materialize(df, "located")
    return df


def id_text(doc_id: Column) -> Column:
    """The id as text; a missing one as the empty text."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it is counted and has few rows.

    ``df`` should be a written table, so that counting it is free.
    """
    return F.broadcast(df) if df.count() <= limit else df


def gathered(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, in one partition if it is counted and has few rows: joins and aggregates of such
    tables then need no shuffle.  Larger ones are left to Spark's partitioning."""
    return df.coalesce(1) if df.count() <= limit else df


def pieces(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Slices (first row, UTF-8 texts) of about ``most`` bytes; null becomes the empty text.
    A single longer text makes a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        part = texts.slice(at, to - at).cast(pa.binary()).to_pylist()
        yield at, [x or b"" for x in part]
        at = to


_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd base modulo 2**64, or of its inverse."""
    table = _tables.get(inverse)
    if table is None or len(table) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        table = np.full(max(n, 1 << 20), base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _tables[inverse] = table
    return table[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers of the base: the hash of the bytes from i up to j is the
    difference of two sums times the inverse power of i."""
    hashed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + 1) * powers(len(data)), out=hashed[1:])
    return hashed
