"""Duplicates: detect them, keep the latest row of a key, or the latest rows of a batch.

``latest_per_key`` is a ranked window cut at 1.  Spark limits each input partition to the
best row of a key *before* the shuffle, so a key that holds a third of all rows reaches the
reducer as one row per map task.

``latest_per_batch`` keeps all rows that share the newest order values, which may be most of
a batch.  It is therefore an aggregate (combined map-side) joined back, never a window: the
join has no per-group state and adaptive execution splits a hot batch over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from lakeloom.functions import named


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [named(c).desc_nulls_last() for c in columns]


def _other_columns(df: DataFrame, taken: Sequence[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in taken and not isinstance(f.dataType, (MapType, VariantType))
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, NULLs last.  Ties are decided by
    ``tie_break``, by default all other columns, so that reruns agree."""
    ties = _other_columns(df, [*keys, *order_by]) if tie_break is None else list(tie_break)
    ranking = [*order_by, *ties]
    if not ranking:
        return df.dropDuplicates(list(keys))
    best = Window.partitionBy(*map(named, keys)).orderBy(*_newest_first(ranking))
    return (
        df.withColumn("__rank", F.row_number().over(best)).filter("__rank = 1").drop("__rank")
    )


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever; always the same one."""
    return latest_per_key(df, keys)


def latest_per_batch(
    df: DataFrame, batch_keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """All rows of each batch that carry its lexicographically greatest ``order_by`` values."""
    value = (
        named(order_by[0]) if len(order_by) == 1 else F.struct(*[named(c) for c in order_by])
    )
    tops = df.groupBy(*map(named, batch_keys)).agg(F.max(value).alias("__top"))
    tops = tops.select(
        *[named(k).alias(f"__k{i}") for i, k in enumerate(batch_keys)],
        *(
            [named("__top").alias("__o0")]
            if len(order_by) == 1
            else [named("__top").getField(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
        ),
    )
    pairs = [(k, f"__k{i}") for i, k in enumerate(batch_keys)]
    pairs += [(c, f"__o{i}") for i, c in enumerate(order_by)]
    same = [named(mine).eqNullSafe(named(top)) for mine, top in pairs]
    return df.join(tops, reduce(and_, same), "left_semi")


def last_batch(df: DataFrame, batch_keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows that equal the maximum of every order column, each taken on its own.  With
    several order columns there may be no such row; NULL keys and values never match."""
    tops = df.groupBy(*map(named, batch_keys)).agg(
        *[F.max(named(c)).alias(f"__max_{c}") for c in order_by]
    )
    tops = tops.select(
        *[named(k).alias(f"__key_{k}") for k in batch_keys],
        *[named(f"__max_{c}") for c in order_by],
    )
    same = [named(k) == named(f"__key_{k}") for k in batch_keys]
    same += [named(c) == named(f"__max_{c}") for c in order_by]
    return df.join(tops, reduce(and_, same), "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice (NULL keys aside)."""
    present = df.dropna(subset=list(keys)) if keys else df
    if example := duplicate_keys(present, keys).limit(1).collect():
        raise ValueError(f"Duplicate rows for key {example[0].asDict()}; give an order to decide.")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*map(named, keys)).distinct()
