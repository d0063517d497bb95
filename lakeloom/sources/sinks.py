"""Writers of target tables.

A table is a folder of parquet files (or of any other ``fmt`` Spark can write).  Partitioned
writes are rebalanced by partition: few, evenly sized files, and a partition that holds much
of the data is spread over many tasks.  That costs a shuffle; callers whose tasks each write
to few partitions anyway switch it off.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType

from lakeloom.functions import named
from lakeloom.operators.filters import since
from lakeloom.shared import materialize, scratch_tables, session_settings
from lakeloom.sources import buckets
from lakeloom.sources.compaction import compact_in_place
from lakeloom.sources.files import file_schema, read_table, table_exists
from lakeloom.sources.records import merged_schema, write_record

#: Files that a task has open at most; with more partitions Spark sorts the rows that are left.
OPEN_FILES = "4"


def _write(
    df: DataFrame,
    path: str,
    mode: str,
    partition_by: Sequence[str],
    fmt: str,
    rebalance: bool = True,
    **options: object,
) -> None:
    if partition_by and rebalance:
        df = df.hint("rebalance", *map(named, partition_by))
    writer = df.write.mode(mode).format(fmt).options(**options)
    if not partition_by:
        writer.save(path)
    elif rebalance:
        writer.partitionBy(*partition_by).save(path)
    else:
        # Tasks that write to few partitions keep their files open instead of sorting their rows.
        with session_settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
            writer.partitionBy(*partition_by).save(path)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    reads_target: bool = False,
    rebalance: bool = True,
) -> None:
    """Replace a table's data and schema.  A plan that reads the files it replaces is written
    to the shared folder first (``reads_target``), so a failure cannot lose the table."""
    with scratch_tables(df.sparkSession):
        if reads_target:
            df = materialize(df, "overwrite")
        _write(
            df, path, "overwrite", partition_by, fmt, rebalance,
            overwriteSchema=True, partitionOverwriteMode="static",
        )
    _record_schema(df, path, fmt)


def _record_schema(df: DataFrame, path: str, fmt: str) -> None:
    if fmt != "delta":  # such tables keep a schema of their own
        write_record(df.sparkSession, path, schema=df.schema.jsonValue())


def overwrite_buckets(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    n: int,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    reads_target: bool = False,
) -> None:
    """Replace a table by one laid out in ``n`` buckets of its keys, outside its partitions."""
    laid = buckets.with_bucket(df, keys, n)
    overwrite(laid, path, [buckets.BUCKET, *partition_by], fmt, reads_target)
    write_record(df.sparkSession, path, buckets=n, bucket_keys=buckets.key_types(df, keys))


def replace_buckets(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    n: int,
    chosen: Sequence[str],
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Replace the ``chosen`` buckets by the rows of ``df``, all of whose keys lie in them; the
    plan may read them.  Partitions of a bucket that have no row any more are removed last: a
    change that fails before is mended by running it again."""
    spark = df.sparkSession
    pattern = "|".join(re.escape(f"{buckets.BUCKET}={label}") for label in chosen)
    before = buckets.leaf_files(spark, path, pattern)
    overwrite_partitions(
        buckets.with_bucket(df, keys, n), path, [buckets.BUCKET, *partition_by], fmt
    )
    buckets.remove_unchanged(spark, before, pattern, path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Replace just the partitions that occur in ``df``; the plan may read them."""
    _write(df, path, "overwrite", partition_by, fmt, rebalance, partitionOverwriteMode="dynamic")


def align_columns(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """The target's columns that still exist, in its order, then new ones."""
    kept = [c for c in target_columns if c in df.columns]
    return df.select(*map(named, [*kept, *(c for c in df.columns if c not in kept)]))


def append_strict(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Append; columns unknown to the table, or of another type, are an error."""
    spark = df.sparkSession
    if table_exists(spark, path):
        known = {f.name: f.dataType for f in read_table(spark, path, fmt=fmt).schema.fields}
        unknown = [c for c in df.columns if c not in known]
        if unknown:
            raise ValueError(f"The table has no columns {unknown}.")
        # A partition column's type is guessed from folder names, so it is not compared.
        wrong = {
            f.name: f"{f.dataType.simpleString()} is not {known[f.name].simpleString()}"
            for f in df.schema.fields
            if f.name not in partition_by and f.dataType != known[f.name]
        }
        if wrong:
            raise TypeError(f"Columns have other types than in the table: {wrong}.")
    _write(df, path, "append", partition_by, fmt, rebalance)


def _complete(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> DataFrame:
    """The rows with all of the table's columns, in its order and in types that hold both, with
    NULL for columns they no longer have.  The table's record gets the merged schema before the
    rows are written: it then knows all columns whatever fails."""
    spark = df.sparkSession
    if fmt == "delta":
        return df
    schema = df.schema
    if table_exists(spark, path):
        held = file_schema(spark, path, partition_by, fmt)
        # A partition column is text in folder names, of the type that new rows give it.
        for f in held.fields:
            if f.name in partition_by and f.name in schema.names:
                f.dataType = schema[f.name].dataType
        schema = merged_schema(held, schema)
        columns = [
            (named(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        kept = [c for c in schema.names if c in df.columns or c not in partition_by]
        df = df.select(*columns).select(*map(named, kept))
    write_record(spark, path, schema=schema.jsonValue())
    return df


def append_evolve(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Append; the table gains new columns and lacks vanished ones for the new rows.  Read
    such a table with ``read_table(..., evolved=True)``."""
    df = _complete(df, path, partition_by, fmt)
    _write(df, path, "append", partition_by, fmt, rebalance, mergeSchema=True)


def replace_since(
    df: DataFrame,
    path: str,
    partition: str,
    mark: str | None,
    fmt: str = "parquet",
    inclusive: bool = True,
) -> None:
    """Append stamps at or after the mark.  An inclusive mark loads its own stamp again;
    replacing whole stamps keeps its rows single and makes reruns safe.  Landed files lie by
    stamp already, so nothing is shuffled."""
    df = _complete(since(df, partition, mark, inclusive), path, [partition], fmt)
    overwrite_partitions(df, path, [partition], fmt, rebalance=False)


def copy_table(
    spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (),
    fmt: str = "parquet", types: Mapping[str, str] | None = None,
) -> None:
    """Copy a table, schema included.  Columns named in ``types`` take those types instead;
    values that do not convert become NULL, and an unknown column is an error."""
    table = read_table(spark, source, fmt=fmt)
    if unknown := set(types or ()) - set(table.columns):
        raise ValueError(f"no columns {sorted(unknown)} in {source}")
    for name, kind in (types or {}).items():
        table = table.withColumn(name, F.col(f"`{name}`").try_cast(kind))
    overwrite(table, target, partition_by, fmt)


def parse_columns(schema: str) -> list[tuple[str, str, int | None]]:
    """``name type, ...`` with bounded strings, as (name, Spark type, bound)."""
    columns = []
    for part in re.split(r",(?![^(]*\))", schema):
        name, kind = part.strip().split(None, 1)
        bounded = re.fullmatch(r"(?:var)?char\s*\(\s*(\d+)\s*\)", kind.strip(), re.IGNORECASE)
        columns.append((name, "string" if bounded else kind, int(bounded[1]) if bounded else None))
    return columns


def fit_schema(df: DataFrame, schema: str) -> DataFrame:
    """Rows in a fixed schema: cast, longer text cut to its bound; booleans do not turn into
    numbers, and columns the source lacks are NULL."""
    fitted = []
    for name, kind, bound in parse_columns(schema):
        if name not in df.columns:
            fitted.append(F.lit(None).cast(kind).alias(name))
            continue
        if isinstance(df.schema[name].dataType, BooleanType) and isinstance(
            DataType.fromDDL(kind), NumericType
        ):
            raise TypeError(f"Column {name} is boolean in the source and {kind} in the target.")
        value = named(name).cast(kind)
        fitted.append((F.left(value, F.lit(bound)) if bound else value).alias(name))
    return df.select(*fitted)


def reload(
    spark: SparkSession, source: str, target: str, schema: str, fmt: str = "parquet"
) -> None:
    """Replace all rows of a table of fixed schema in one write."""
    overwrite(fit_schema(read_table(spark, source, fmt=fmt), schema), target, fmt=fmt)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Put small files together: in place, where only fragmented partitions are rewritten, or
    as a copy with other partitions, whose file sizes follow the advisory partition size."""
    if target == path:
        compact_in_place(spark, path, fmt)
        return
    df = read_table(spark, path, fmt=fmt, evolved=True)
    if not partition_by:
        df = df.hint("rebalance")
    overwrite(df, target, partition_by, fmt)
    spark.catalog.refreshByPath(target)
