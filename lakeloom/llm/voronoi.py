"""Exact nearest rows by inner product with a Voronoi join.

Pivots part the vectors into Voronoi cells.  Queries are put into blocks of neighbouring cells.
Summaries of the cells (radius of the queries, distances and norms of the rows nearest to a
pivot, largest norm) bound for every block how far a row of another cell may lie from its pivot
and still be needed; only such rows are copied to the block, and there the query is solved
exactly.  For a query ``q`` a larger inner product with ``s`` is a larger
``f(s) = |s|^2 - |q - s|^2``, and the triangle inequality bounds ``|q - s|`` from both sides, so
no vector has to have a given length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import arrow_udf, located, ship, small
from lakeloom.shared import materialize

#: Rows that the pivots are fitted on, and most pivots; fewer for fewer rows.
SAMPLE_ROWS, PIVOTS = 2048, 256
#: Queries of a block, and rows of one piece of what a block needs: they bound a task.
BLOCK_ROWS, PIECE_ROWS = 4096, 4096
#: Components are multiplied by this and rounded down.
SCALE = 256.0
#: Vectors with larger components have no pivot near them and go to every block.
_LARGE = 1e100
#: Bounds are loosened by this share against rounding.
_SLACK = 1e-9
_TILE = 256


def takes_part(vector: Column, scale: float = SCALE) -> Column:
    """Not null, and every component finite, also when scaled."""

    def finite(x: Column) -> Column:
        wide = x.cast("double") * F.lit(scale)
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_numbers(column: pa.Array | pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    """Vectors of ``width`` components as a matrix of whole numbers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * values).reshape(len(flat), width)


def fit_pivots(sample: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """``n`` pivots by a few rounds of k-means, those that lie close to each other in a row."""
    rng = np.random.default_rng(seed)
    pivots = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(5):
        nearest = ((pivots**2).sum(1) - 2 * sample @ pivots.T).argmin(1)
        held = np.bincount(nearest, minlength=len(pivots))
        total = np.zeros_like(pivots)
        np.add.at(total, nearest, sample)
        pivots = np.where(held[:, None] > 0, total / np.maximum(held, 1)[:, None], pivots)
    order, left = [0], list(range(1, len(pivots)))
    while left:
        away = ((pivots[left] - pivots[order[-1]]) ** 2).sum(1)
        order.append(left.pop(int(away.argmin())))
    return pivots[order]


CELL = T.StructType().add("cell", T.IntegerType()).add("r", T.DoubleType()).add("norm2", T.DoubleType())


def nearest_pivot(vector: Column, pivots: np.ndarray, scale: float) -> Column:
    """Per vector: its cell, the distance to its pivot and its squared length.  Vectors and
    pivots of different lengths are compared as if zeros followed."""

    @arrow_udf(CELL)
    def run(vectors: pa.Array) -> pa.Array:
        widths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        cell, r, norm2 = np.zeros(len(vectors), np.int32), np.zeros(len(vectors)), np.zeros(len(vectors))
        beyond = (pivots**2).sum(1)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            common = min(width, pivots.shape[1])
            near = pivots[:, :common]
            rest = beyond - (near**2).sum(1)
            for rows in np.array_split(at, -(-len(at) // 4096)):
                x = whole_numbers(vectors.take(pa.array(rows)), int(width), scale)
                large = np.abs(x).max(1, initial=0) > _LARGE
                x[large] = 0
                mine = (beyond - 2 * x[:, :common] @ near.T).argmin(1)
                gap = ((x[:, :common] - near[mine]) ** 2).sum(1) + (x[:, common:] ** 2).sum(1)
                cell[rows], norm2[rows] = mine, (x**2).sum(1)
                r[rows] = np.sqrt(gap + np.maximum(rest[mine], 0))
                r[rows[large]] = norm2[rows[large]] = np.inf
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(r), pa.array(norm2)], CELL.names)

    return run(vector)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exact; what a bigint can't
    hold becomes the nearest bigint."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    wide = np.frompyfunc(int, 1, 1)
    total = wide(a).dot(wide(b).T)
    return np.clip(total, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest of each row, ties to the first column; entries of
    the least bigint count as absent."""
    absent = np.iinfo(np.int64).min
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    else:
        least = np.full(len(scores), absent)
    row, column = np.nonzero((scores >= least[:, None]) & (scores > absent))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], column[keep]


def _cells(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Summaries by (width, cell): of all rows, and the k + 1 rows nearest to each pivot."""
    held = rows.groupBy("width", "cell").agg(
        F.count("*").alias("held"), F.max("r").alias("widest"), F.max("norm2").alias("longest")
    )
    near = Window.partitionBy("width", "cell").orderBy("r", "norm2")
    core = rows.select("width", "cell", "r", "norm2", F.row_number().over(near).alias("k"))
    core = core.where(F.col("k") <= k + 1).select("width", "cell", "r", "norm2")
    return materialize(held, "cells"), materialize(core, "cell-cores")


def _routes(rows: DataFrame, pivots: np.ndarray, k: int, block_rows: int, piece_rows: int):
    """Query cells with their place in the order of queries; routes (width, cell, block, from):
    the rows of a cell at least ``from`` away from their pivot are needed by the block; and the
    number of pieces of each block."""
    spark = rows.sparkSession
    held, core = _cells(rows, k)
    n = len(pivots)
    apart = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2)).ravel()
    grid = pa.table({"asked": np.repeat(np.arange(n), n), "cell": np.tile(np.arange(n), n), "d": apart})
    grid = small(materialize(spark.createDataFrame(grid), "pivots"))
    asking = rows.where("asks").groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("r").alias("radius"))
    before = Window.partitionBy("width").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    asking = asking.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    asking = materialize(asking, "query-cells")
    asked = asking.withColumnRenamed("cell", "asked").join(grid, "asked")
    # f of the (k + 1)-th best core row, a query itself being one of them at most.
    reach = F.col("radius") + F.col("d") + F.col("r")
    low = (F.col("norm2") - reach * reach) - _SLACK * (F.col("norm2") + reach * reach)
    low = F.when(reach < float("inf"), low).otherwise(-float("inf"))
    rank = F.row_number().over(Window.partitionBy("width", "asked").orderBy(F.desc("low")))
    sure = asked.join(core, ["width", "cell"]).select("width", "asked", low.alias("low"))
    sure = sure.withColumn("k", rank).where(F.col("k") == k + 1).select("width", "asked", F.col("low").alias("sure"))
    room = F.sqrt(F.greatest(F.lit(0.0), F.col("longest") - F.col("sure")))
    start = F.col("d") - F.col("radius") - room
    start = start - _SLACK * (F.col("d") + F.col("radius") + room)
    start = F.when(F.col("sure").isNull(), 0.0).when(F.col("longest") >= F.col("sure"), start)
    first, last = (F.floor(x / block_rows) for x in (F.col("start"), F.col("start") + F.col("n") - 1))
    routes = (
        asked.join(sure, ["width", "asked"], "left")
        .join(held, ["width", "cell"])
        .select("width", "cell", "held", "widest", start.alias("from"), F.explode(F.sequence(first, last)).alias("block"))
        .where(F.col("from") <= F.col("widest"))
        .groupBy("width", "cell", "block")
        .agg(F.min("from").alias("from"), F.first("held").alias("held"))
    )
    routes = materialize(routes, "routes")
    parts = routes.groupBy("width", "block").agg(F.ceil(F.sum("held") / piece_rows).alias("pieces"))
    return asking, routes, materialize(parts, "pieces")


RESULT = "query_file bigint, query_at bigint, query_id {id}, vec_id {id}, file bigint, at bigint, score bigint"


def largest_products(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    *,
    scale: float = SCALE,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
    piece_rows: int = PIECE_ROWS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` other rows with the largest
    inner product, an exact bigint, of the vectors of ``floor(scale * component)``.

    ``queries`` says which rows are queries (null: no); candidates are all rows but a query's
    own, also those with its id or its vector.  Ties go to the smaller id (null last), then to
    the place in the files.  Vectors that are null or hold a null or non-finite component, or
    one that isn't finite when scaled, take no part; zero vectors do.  Vectors of different
    lengths are not compared.  A score beyond a bigint is given as the nearest bigint.
    Queries with fewer than ``k`` candidates return all of them; an empty table gives an empty
    result.

    A task holds a piece of about ``piece_rows`` rows and a block of about ``block_rows``
    queries, whatever the size of a cell: equal vectors share a cell, not a task.  Where no
    bound excludes anything (vectors without structure) every row goes to every block once.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = located(vectors.select(vec_id, embedding, queries.alias("asks")))
    rows = rows.where(takes_part(F.col(f"row.{embedding}"), scale)).select(
        F.col(f"row.{vec_id}").alias("vec_id"),
        F.col(f"row.{embedding}").alias("v"),
        F.coalesce("row.asks", F.lit(False)).alias("asks"),
        F.size(f"row.{embedding}").alias("width"),
        "file",
        "at",
    )
    rows = materialize(rows, "vectors")
    total = rows.count()
    place = F.xxhash64("file", "at")
    picked = rows.where(F.pmod(place, F.lit(max(1, total))) < SAMPLE_ROWS).select("v", "width")
    sample = picked.limit(2 * SAMPLE_ROWS).toArrow()
    widths = np.bincount(sample["width"].to_numpy()) if len(sample) else np.zeros(1, int)
    width = int(widths.argmax())
    sample = sample.filter(pc.equal(sample["width"], width))
    known = whole_numbers(sample["v"], width, scale) if len(sample) else np.zeros((1, 1))
    known = known[np.abs(known).max(1, initial=0) <= _LARGE]
    known = known if len(known) else np.zeros((1, width))
    centres = fit_pivots(known, max(1, min(pivots, math.isqrt(total) // 8)))
    rows = rows.withColumn("c", nearest_pivot(F.col("v"), centres, scale)).select("*", "c.*").drop("c")
    rows = materialize(rows, "vector-cells")
    asking, routes, parts = _routes(rows, centres, k, block_rows, piece_rows)
    parts = small(parts)

    there = rows.join(small(routes), ["width", "cell"]).where(F.col("r") >= F.col("from"))
    piece = F.pmod(F.xxhash64(place), F.col("pieces")).alias("piece")
    there = there.join(parts, ["width", "block"]).select("width", "block", piece, "vec_id", "v", "file", "at")
    block = F.floor((F.col("start") + F.pmod(place, F.col("n"))) / block_rows).alias("block")
    asks = rows.where("asks").join(small(asking), ["width", "cell"])
    asks = asks.select("width", block, "vec_id", "v", "file", "at").join(parts, ["width", "block"])
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece")
    asks = asks.select("width", "block", pieces, "vec_id", "v", "file", "at")
    asks = asks.toDF(*asks.columns)  # columns apart from those of ``there``

    id_type = rows.schema["vec_id"].dataType.simpleString()
    names = ["query_file", "query_at", "query_id", "vec_id", "file", "at", "score"]

    def solve(key: tuple, near: pa.Table, ask: pa.Table) -> pa.Table:
        kind = near.schema.field("vec_id").type
        kinds = [pa.int64(), pa.int64(), kind, kind, pa.int64(), pa.int64(), pa.int64()]
        ranked = [(c, "ascending") for c in ("vec_id", "file", "at")]
        near = near.take(pc.sort_indices(near, ranked, null_placement="at_end"))
        wide = key[0].as_py()
        a, b = whole_numbers(near["v"], wide, scale), whole_numbers(ask["v"], wide, scale)
        places = {p: i for i, p in enumerate(zip(near["file"].to_pylist(), near["at"].to_pylist(), strict=True))}
        own = [places.get(p, -1) for p in zip(ask["file"].to_pylist(), ask["at"].to_pylist(), strict=True)]
        own = np.array(own, np.int64)
        found = [(np.zeros(0, np.int64),) * 3]
        for at in range(0, len(b), _TILE) if len(a) else ():
            scores = products(b[at : at + _TILE], a)
            # The least bigint marks a query's own row; no other entry has it.
            scores = np.maximum(scores, np.iinfo(np.int64).min + 1)
            mine = np.flatnonzero(own[at : at + _TILE] >= 0)
            scores[mine, own[at + mine]] = np.iinfo(np.int64).min
            query, row = best(scores, k)
            found.append((query + at, row, scores[query, row]))
        query, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
        columns = [ask[c].take(pa.array(query)) for c in ("file", "at", "vec_id")]
        columns += [near[c].take(pa.array(row)) for c in ("vec_id", "file", "at")] + [pa.array(score)]
        return pa.table(dict(zip(names, columns, strict=True))).cast(pa.schema(list(zip(names, kinds, strict=True))))

    key = ["width", "block", "piece"]
    found = there.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(solve, RESULT.format(id=id_type))
    ranks = Window.partitionBy("query_file", "query_at").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "file", "at"
    )
    return (
        found.withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
