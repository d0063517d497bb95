"""Nearest neighbours by cosine with a vantage-point tree per shard.

Unit vectors under the Euclidean distance are a metric space, where a larger cosine is a
smaller distance.  A node splits its vectors by their distance to a vantage point; a child can
be passed over if the triangle inequality puts all of it beyond the nearest found so far.  That
bound is multiplied by ``factor``: with 1 the search is exact, larger factors prune more.
Whole blocks of queries walk the tree together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import located, ship
from lakeloom.shared import materialize

#: Vectors of a shard and queries of a block, on average: they bound what a task holds.
SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 8192, 256
#: 1 is exact.
FACTOR = 1.0
_SLACK = 1e-9


def takes_part(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""

    def finite(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Tree:
    """A tree over the rows of ``units`` (unit vectors)."""

    def __init__(self, units: np.ndarray, leaf: int = LEAF, seed: int = 0) -> None:
        self.units, self.leaf = units, leaf
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(units)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = self.units[rows[self.random.integers(len(rows))]]
        away = _distance(self.units[rows] @ vantage)
        half = len(rows) // 2
        order = np.argpartition(away, half)
        children = []
        for part in (order[:half], order[half:]):
            reach = away[part].min(), away[part].max()
            children.append((reach, self._build(rows[part])))
        return vantage, children

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float):
        """Pairs (query, row) that hold the ``k`` nearest of each query and all that tie with
        them up to rounding.  ``own`` is the row that a query must not find, or -1."""
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.best = np.full((len(queries), k), -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(queries) and len(self.units):
            self._visit(self.root, np.arange(len(queries)))
        if not self.found:
            return np.zeros(0, int), np.zeros(0, int)
        query, row, near = (np.concatenate(x) for x in zip(*self.found, strict=True))
        keep = near >= self.best[query, 0] - _SLACK
        return query[keep], row[keep]

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            near = self.queries[active] @ self.units[node].T
            near[node[None, :] == self.own[active][:, None]] = -np.inf
            both = np.hstack([self.best[active], near])
            self.best[active] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
            # Column 0 of a partition is the k-th largest.
            hit = (near >= self.best[active, 0][:, None] - _SLACK) & (near > -np.inf)
            query, at = np.nonzero(hit)
            self.found.append((active[query], node[at], near[query, at]))
            return
        vantage, children = node
        away = _distance(self.queries[active] @ vantage)
        bounds = [np.maximum(np.maximum(low - away, away - high), 0) for (low, high), _ in children]
        first = (bounds[1] < bounds[0]).astype(int)
        first = np.where(
            bounds[0] == bounds[1],
            np.abs(away - sum(children[1][0]) / 2) < np.abs(away - sum(children[0][0]) / 2),
            first,
        )
        for turn in (0, 1):
            for side in (0, 1):
                mine = (first == side) if turn == 0 else (first != side)
                reach = _distance(self.best[active, 0])
                mine &= bounds[side] * self.factor <= reach + 1e-6
                self._visit(children[side][1], active[mine])


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices, in double precision.  Sums run from the first
    component to the last, so equal rows get equal values.  Rows are scaled by powers of two,
    which rounds nothing, so that no square leaves the range of doubles."""

    def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for i in range(x.shape[1]):
            total += x[:, i] * y[:, i]
        return total

    a, b = _scaled(a), _scaled(b)
    return np.clip(dot(a, b) / np.sqrt(dot(a, a) * dot(b, b)), -1, 1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, the largest component between a half and one."""
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 1)


RESULT = "query_file bigint, query_at bigint, query_id {id}, vec_id {id}, file bigint, at bigint, score double"


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    *,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest other rows.

    ``queries`` says which rows are queries; candidates are all rows but a query's own, also
    those with its id or its vector.  Ties go to the smaller id (null last), then to the place
    in the files.  Vectors of different lengths are not compared.  Queries with fewer than
    ``k`` candidates return all of them; an empty table gives an empty result.

    Shards meet blocks of queries in a grid, and a task holds one cell: ``shard_rows`` vectors
    and ``block_rows`` queries, whatever the size of the table.
    """
    rows = located(vectors.select(vec_id, embedding, queries.alias("asks")))
    rows = materialize(
        rows.where(takes_part(F.col(f"row.{embedding}"))).select(
            F.col(f"row.{vec_id}").alias("vec_id"),
            F.col(f"row.{embedding}").alias("v"),
            F.coalesce("row.asks", F.lit(False)).alias("asks"),
            F.size(f"row.{embedding}").alias("width"),
            "file",
            "at",
        ),
        "vectors",
    )
    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = -(-total // shard_rows) or 1, -(-asking // block_rows) or 1
    place = F.xxhash64("file", "at")
    shard = F.pmod(place, F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(place), F.lit(blocks)).cast("int")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select("*", shard.alias("shard"), numbers(blocks).alias("block")).drop("asks")
    asked = rows.where("asks").select("*", block.alias("block"), numbers(shards).alias("shard")).drop("asks")
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def search(there: pa.Table, ask: pa.Table) -> pa.Table:
        if not there.num_rows or not ask.num_rows:
            return pa.table({f: pa.array([], t) for f, t in zip(names, kinds(there), strict=True)})
        a, b = _matrix(there["v"]), _matrix(ask["v"])
        places = {p: i for i, p in enumerate(zip(there["file"].to_pylist(), there["at"].to_pylist(), strict=True))}
        own = [places.get(p, -1) for p in zip(ask["file"].to_pylist(), ask["at"].to_pylist(), strict=True)]
        query, row = Tree(_units(a)).search(_units(b), np.array(own), k, factor)
        score = cosines(b[query], a[row])
        ids = there["vec_id"].to_pandas()
        rank_id = np.empty(len(ids), np.int64)
        order = np.lexsort((there["at"].to_numpy(), there["file"].to_numpy(), _id_order(ids)))
        rank_id[order] = np.arange(len(ids))
        order = np.lexsort((rank_id[row], -score, query))
        query, row, score = query[order], row[order], score[order]
        start = np.concatenate([[True], query[1:] != query[:-1]]) if len(query) else np.zeros(0, bool)
        since = np.arange(len(query)) - np.maximum.accumulate(np.where(start, np.arange(len(query)), 0))
        top = since < k
        query, row, score = query[top], row[top], score[top]
        return pa.table(
            [ask["file"].take(query), ask["at"].take(query), ask["vec_id"].take(query)]
            + [there["vec_id"].take(row), there["file"].take(row), there["at"].take(row), pa.array(score)],
            names=names,
        )

    names = ["query_file", "query_at", "query_id", "vec_id", "file", "at", "score"]

    def kinds(t: pa.Table) -> list[pa.DataType]:
        i = t.schema.field("vec_id").type
        return [pa.int64(), pa.int64(), i, i, pa.int64(), pa.int64(), pa.float64()]

    ship(vectors.sparkSession)
    key = ["width", "shard", "block"]
    found = candidates.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        search, RESULT.format(id=id_type)
    )
    best = Window.partitionBy("query_file", "query_at").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "file", "at"
    )
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _id_order(ids) -> np.ndarray:
    """Positions of ids in ascending order, null last."""
    codes = ids.rank(method="dense", na_option="bottom").to_numpy()
    return codes
