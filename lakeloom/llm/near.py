"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the set of its shingles of five words.  Each shingle's arrivals are a Poisson
process whose rate is its weight; every arrival falls into one register, which keeps the
earliest.  Two documents agree in a register with the probability Jaccard similarity of their
weighted sets.  All shingles weigh one, however often they come, so this is the Jaccard
similarity of the sets, by which candidates are judged.  A shingle's process ends once it is later than all
registers.  Documents that agree in a band of registers are candidates, and candidates are
links if the Jaccard similarity of their shingle sets is at least 0.8, computed exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm import graph
from lakeloom.llm.common import arrow_udf, located, pieces, powers, prefix_hash, scanned, small
from lakeloom.shared import materialize

SHINGLE, SIMILARITY = 5, 0.8
#: 25 bands of 5: candidates of similarity 0.8 are missed once in 20,000 pairs.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all."""
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of the distinct shingles of UTF-8 texts, by document and hash.

    Words are what white space parts, in lower case.  A text of fewer than five words is one
    shingle; one without words has none.
    """
    lower = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    data = np.frombuffer(b" " + b" ".join(lower) + b" ", np.uint8)
    gaps = np.cumsum([len(t) + 1 for t in lower])
    space = _SPACE[data]
    first = np.flatnonzero(~space[1:] & space[:-1]) + 1
    stop = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    hashed = prefix_hash(data)
    word = _mixed((hashed[stop] - hashed[first]) * powers(len(data), True)[first])
    doc = np.searchsorted(gaps, first, "right")
    n = len(word)
    total = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, n)):
        total *= _ODD
        total[: n - i] += word[i:]
    whole = np.zeros(n, bool)
    if n >= SHINGLE:
        whole[: n - SHINGLE + 1] = doc[: n - SHINGLE + 1] == doc[SHINGLE - 1 :]
    # Short texts: from their first word on, as many as there are.
    counts = np.bincount(doc, minlength=len(texts))
    at = np.cumsum(counts) - counts
    for d in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        some = int(counts[d])
        for w in word[at[d] : at[d] + counts[d]].tolist():
            some = (some * int(_ODD) + w) & (2**64 - 1)
        total[at[d]] = some
        whole[at[d]] = True
    doc, total = doc[whole], _mixed(total[whole])
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    start = np.flatnonzero(new)
    return doc[start], total[start], np.diff(np.append(start, len(doc)))


def sketches(n: int, doc: np.ndarray, item: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Registers of ``n`` documents: the item with the earliest arrival in each."""
    earliest = np.full(n * REGISTERS, np.inf)
    kept = np.zeros(n * REGISTERS, np.uint64)
    time = np.zeros(len(item))
    live = np.arange(len(item))
    turn = 0
    while len(live):
        turn += 1
        draw = _mixed(item[live] + np.uint64((turn * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[live] -= np.log(uniform) / weight[live]
        where = (_mixed(draw ^ _ODD) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
        slot = doc[live] * REGISTERS + where.astype(np.int64)
        now = time[live]
        np.minimum.at(earliest, slot, now)
        won = earliest[slot] == now
        kept[slot[won]] = item[live[won]]
        last = earliest.reshape(n, REGISTERS).max(1)
        live = live[now < last[doc[live]]]
    return kept.reshape(n, REGISTERS)


def bands(registers: np.ndarray) -> np.ndarray:
    total = np.zeros((len(registers), BANDS), np.uint64)
    for i in range(ROWS):
        total = _mixed(total * _ODD + registers[:, i::ROWS])
    return total + np.arange(BANDS, dtype=np.uint64)


SKETCH = (
    T.StructType()
    .add("n", T.IntegerType())
    .add("same", T.StringType())
    .add("bands", T.ArrayType(T.LongType()))
)


def sketch(text: Column) -> Column:
    """Per text: ``n`` distinct shingles, ``same`` (a digest of their set) and ``bands``."""

    @arrow_udf(SKETCH)
    def run(texts: pa.Array) -> pa.Array:
        sizes, same, keys = [], [], []
        for _, part in pieces(texts, 2_000_000):
            doc, item, _ = shingles(part)
            keys.append(bands(sketches(len(part), doc, item, np.ones(len(item)))).astype(np.int64).ravel())
            n = np.bincount(doc, minlength=len(part))
            ends = np.cumsum(n)
            for size, end in zip(n.tolist(), ends.tolist(), strict=True):
                sizes.append(size)
                same.append(hashlib.blake2b(item[end - size : end].tobytes(), digest_size=16).hexdigest())
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        listed = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS, pa.array(flat))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int32()), pa.array(same, pa.string()), listed], ["n", "same", "bands"]
        )

    return run(text)


def shingle_set(text: Column) -> Column:
    @arrow_udf(T.ArrayType(T.LongType()))
    def run(texts: pa.Array) -> pa.Array:
        sizes, items = [np.zeros(1, np.int64)], []
        for _, part in pieces(texts, 2_000_000):
            doc, item, _ = shingles(part)
            sizes.append(np.bincount(doc, minlength=len(part)))
            items.append(item.astype(np.int64))
        flat = np.concatenate(items) if items else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(np.cumsum(np.concatenate(sizes)).astype(np.int32), pa.array(flat))

    return run(text)


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, its place (``file``, ``at``), ``class_id`` (the
    smallest doc_id of its class, null only if all are), ``class_size`` and ``kept`` (one row
    of each class: the smallest doc_id, then the first by place).

    A class is a connected component of links.  Texts with equal shingle sets are one text to
    the search, whatever their number.  Null, empty and blank texts have no shingles and are
    each a class of their own.  An empty table gives an empty result.
    """
    at = located(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    at = at.select("row.doc_id", "row.text", "file", "at")
    rows = at.withColumn("s", sketch(F.col("text"))).select("doc_id", "file", "at", "s.*")
    rows = materialize(rows, "sketches")
    # One row of each shingle set stands for all of them.
    first = Window.partitionBy("same").orderBy("file", "at")
    heads = rows.where("n > 0").withColumn("k", F.row_number().over(first)).where("k = 1")
    heads = heads.select("same", "n", "bands", "file", "at", F.monotonically_increasing_id().alias("id"))
    heads = materialize(heads, "heads")
    members = graph.shared_buckets(heads.select(F.explode("bands").alias("bucket"), "id"))
    wanted = members.select("id").distinct().join(heads.drop("bands", "same"), "id")
    wanted = materialize(wanted, "wanted")
    sets = at.join(small(wanted.drop("n")), ["file", "at"])
    sets = materialize(sets.select("id", shingle_set(F.col("text")).alias("items")), "shingle-sets")
    # Shingles that no other candidate has cannot be shared: they bound the similarity.
    own = (
        sets.select(F.explode("items").alias("item"), "id")
        .groupBy("item")
        .agg(F.count("*").alias("holders"), F.min("id").alias("id"))
        .where("holders = 1")
        .groupBy("id")
        .agg(F.count("*").alias("own"))
    )
    info = F.struct("n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared")).alias("info")
    infos = wanted.join(own, "id", "left").select("id", info)
    infos = materialize(infos.where(F.col("info.shared") >= F.col("info.n") * similarity), "infos")
    members = materialize(members.join(infos, "id"), "members")

    def possible(a: Column, b: Column) -> Column:
        most = F.least(a["shared"], b["shared"])
        return most >= (a["n"] + b["n"] - most) * similarity

    def verify(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("items").alias("xa"))
        y = sets.select(F.col("id").alias("b"), F.col("items").alias("xb"))
        held = pairs.join(x, "a").join(y, "b")
        held = held.withColumn("both", F.size(F.array_intersect("xa", "xb")))
        either = F.size("xa") + F.size("xb") - F.col("both")
        return held.where(F.col("both") >= either * similarity)

    all_bands = heads.select("id", F.col("bands").alias("buckets"))
    known = graph.linked(members, verify, possible, "info.n - info.shared", buckets=all_bands)
    roots = heads.select("id", "same").join(small(known), "id").select("same", "root")
    found = rows.join(small(materialize(roots, "near-roots")), "same", "left")
    found = found.withColumn("root", F.col("root").cast("string"))
    alone = F.concat_ws(":", "file", "at")
    group = F.when(F.col("n") == 0, alone).otherwise(F.coalesce("root", "same"))
    found = found.select("doc_id", "file", "at", group.alias("group"))
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "at")
    sized = found.groupBy("group").agg(F.min(entry).alias("keep"), F.count("*").alias("class_size"))
    sized = materialize(sized.where("class_size > 1"), "classes")
    joined = found.join(small(sized), "group", "left")
    shared = F.col("keep").isNotNull()
    is_kept = (F.col("keep.file") == F.col("file")) & (F.col("keep.at") == F.col("at"))
    return joined.select(
        "doc_id",
        "file",
        "at",
        F.when(shared, F.col("keep.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
        (~shared | is_kept).alias("kept"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class."""
    docs = scanned(docs)
    found = classes(docs, **options)
    gone = materialize(found.where("not kept").select("file", "at"), "near-gone")
    return located(docs).join(small(gone), ["file", "at"], "left_anti").select("row.*")
