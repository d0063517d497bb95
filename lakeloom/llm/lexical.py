"""Ranked lexical search of many items at once, by evaluating what they share only once.

All documents are counted once for the terms of a block of items.  Among the items, shared term
sets are mined: sets of terms that come in the same items first, then, the most shared pair
first, pairs of terms or sets that two items or more have.  The sets form a graph; each
document's partial score of a set is computed once, from its parts, and items add up the few
sets and terms they are left with.  Scores are whole numbers, so the order of adding does not
matter.  Each task keeps the best documents of every item, and a window ranks what tasks kept.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import arrow_udf, located, pieces, ship
from lakeloom.shared import materialize

#: Items evaluated together: they bound what is sent to tasks.
BLOCK_ITEMS = 1024
#: Pairs are mined among so many parts of an item, the most shared ones.  This bounds the
#: mining only; scores do not depend on what is found.
MINED_PARTS = 256
#: Numbers in a task's accumulators at a time.
CELLS = 1 << 22
_CHUNK = 4_000_000

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term comes in UTF-8: runs of ASCII letters and digits and of all other
    characters, A-Z in lower case.  Long texts are counted in parts cut between terms."""
    if len(text) <= _CHUNK:
        return Counter(_TERM.findall(text.translate(_LOWER)))
    counts, at = Counter(), 0
    while at < len(text):
        end = _BREAK.search(text, min(len(text), at + _CHUNK))
        stop = end.start() if end else len(text)
        counts.update(_TERM.findall(text[at:stop].translate(_LOWER)))
        at = stop + 1
    return counts


def distinct_terms(text: Column) -> Column:
    @arrow_udf(T.ArrayType(T.BinaryType()))
    def run(texts: pa.Array) -> pa.Array:
        found = [sorted(term_counts(t)) for _, part in pieces(texts) for t in part]
        return pa.array(found, pa.list_(pa.binary()))

    return run(text)


COUNTS = (
    T.StructType()
    .add("n", T.LongType())
    .add("terms", T.ArrayType(T.IntegerType()))
    .add("tf", T.ArrayType(T.LongType()))
)


def counted(text: Column, vocabulary: dict[bytes, int]) -> Column:
    """Per text: ``n`` terms with repeats, and number and count of those of the vocabulary."""

    @arrow_udf(COUNTS)
    def run(texts: pa.Array) -> pa.Array:
        sizes, ends, terms, tf = [], [0], [], []
        for _, part in pieces(texts):
            for text in part:
                counts = term_counts(text)
                sizes.append(counts.total())
                for term in counts.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    tf.append(counts[term])
                ends.append(len(terms))
        ends = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((terms, pa.int32()), (tf, pa.int64()))]
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), *lists], COUNTS.names)

    return run(text)


class Shared:
    """The graph of term sets that items share.

    ``items`` are the items' distinct terms by number.  Part ``i`` below ``terms`` is a term;
    each further one is the sum of the two of ``made``.  ``left`` are the parts that an item
    adds up itself.
    """

    def __init__(self, items: list[list[int]], terms: int, mined: int = MINED_PARTS) -> None:
        self.terms = terms
        self.made: list[tuple[int, int]] = []
        parts = [set(x) for x in items]
        self._same_items(parts)
        self._pairs(parts, mined)
        self.left = [sorted(x) for x in parts]

    def _join(self, a: int, b: int) -> int:
        self.made.append((a, b))
        return self.terms + len(self.made) - 1

    def _same_items(self, parts: list[set[int]]) -> None:
        """Terms that come in the same two items or more become one set."""
        holders = defaultdict(list)
        for i, have in enumerate(parts):
            for t in have:
                holders[t].append(i)
        classes = defaultdict(list)
        for t in sorted(holders):
            if len(holders[t]) > 1:
                classes[tuple(holders[t])].append(t)
        for those, members in classes.items():
            whole = members[0]
            for t in members[1:]:
                whole = self._join(whole, t)
            if len(members) > 1:
                for i in those:
                    parts[i].difference_update(members)
                    parts[i].add(whole)

    def _pairs(self, parts: list[set[int]], mined: int) -> None:
        """The pair that most items have becomes a set of its own, until none has two."""
        shared = Counter(p for have in parts for p in have)
        open_parts = [set(heapq.nsmallest(mined, (p for p in have if shared[p] > 1), key=lambda p: (-shared[p], p))) for have in parts]
        holders: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, have in enumerate(open_parts):
            ordered = sorted(have)
            for x, a in enumerate(ordered):
                for b in ordered[x + 1 :]:
                    holders[a, b].add(i)
        heap = [(-len(h), p) for p, h in holders.items() if len(h) > 1]
        heapq.heapify(heap)
        while heap:
            n, pair = heapq.heappop(heap)
            now = holders.get(pair, ())
            if len(now) < 2:
                continue
            if len(now) != -n:
                heapq.heappush(heap, (-len(now), pair))
                continue
            whole, grown = self._join(*pair), set()
            for i in sorted(now):
                parts[i].difference_update(pair)
                parts[i].add(whole)
                open_parts[i].difference_update(pair)
                for p in open_parts[i]:
                    for old in pair:
                        holders[min(p, old), max(p, old)].discard(i)
                    holders[p, whole].add(i)
                    grown.add((p, whole))
                open_parts[i].add(whole)
            del holders[pair]
            for p in grown:
                if len(holders[p]) > 1:
                    heapq.heappush(heap, (-len(holders[p]), p))

    def levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(sets, first parts, second parts) that can be computed together, in order."""
        depth: dict[int, int] = {}
        by_depth = defaultdict(list)
        for k, (a, b) in enumerate(self.made):
            part = self.terms + k
            depth[part] = 1 + max(depth.get(a, 0), depth.get(b, 0))
            by_depth[depth[part]].append((part, a, b))
        return [tuple(np.array(x).T) for _, x in sorted(by_depth.items())]


def evaluate(shared: Shared, n_docs: int, doc: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Scores (item, document) from the values of the (document, term) pairs: every shared set
    is accumulated once."""
    present, row = np.unique(term, return_inverse=True)
    # Row 0 stands for all terms that no document has; sets follow the terms.
    place = np.zeros(shared.terms + len(shared.made), np.int64)
    place[present] = np.arange(1, len(present) + 1)
    place[shared.terms :] = np.arange(len(shared.made)) + len(present) + 1
    sums = np.zeros((1 + len(present) + len(shared.made), n_docs), np.int64)
    sums[row + 1, doc] = value
    for whole, a, b in shared.levels():
        sums[place[whole]] = sums[place[a]] + sums[place[b]]
    scores = np.zeros((len(shared.left), n_docs), np.int64)
    for i, parts in enumerate(shared.left):
        if parts:
            scores[i] = sums[place[parts]].sum(0)
    return scores


class _Best:
    """The best documents of each item so far; ``order`` are the columns that rank them."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.ones(items, np.int64)
        self.held: list[tuple] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: pa.Array, file: np.ndarray, at: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.held.append((item, scores[item, doc], ids.take(pa.array(doc)), file[doc], at[doc]))
        self.size += len(item)
        if self.size > 4 * self.k * len(self.least) + 100_000:
            self.cut()

    def cut(self) -> None:
        if not self.held:
            return
        item, score, file, at = (np.concatenate([h[i] for h in self.held]) for i in (0, 1, 3, 4))
        ids = pa.concat_arrays([h[2] for h in self.held])
        by_id = pc.rank(ids, null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.lexsort((at, file, by_id, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - first[item[order]]
        # What ties with the last one kept may still come with a smaller id.
        full = order[rank == self.k - 1]
        self.least[item[full]] = score[full]
        keep = order[rank < self.k]
        self.held = [(item[keep], score[keep], ids.take(pa.array(keep)), file[keep], at[keep])]
        self.size = len(keep)


def _values(tf: np.ndarray, weight: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _ranked(counts: DataFrame, shared: Shared, weights: np.ndarray, mean: tuple[int, int], k: int) -> DataFrame:
    """The best ``k`` documents of each item: (item, doc_id, file, at, score)."""
    docs_n, terms_n = mean
    kind = counts.schema["doc_id"].dataType.simpleString()
    step = max(1, CELLS // (1 + len(weights) + len(shared.made) + len(shared.left)))
    step = max(64, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(shared.left), k)
        ids_type = None
        for batch in batches:
            ids_type = batch.column("doc_id").type
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                n = part.column("n").to_numpy()
                m = 50 + (50 * n * docs_n) // terms_n
                sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term = part.column("terms").flatten().to_numpy()
                value = _values(part.column("tf").flatten().to_numpy(), weights[term], m[doc])
                scores = evaluate(shared, part.num_rows, doc, term, value)
                place = part.column("file").to_numpy(), part.column("at").to_numpy()
                best.add(scores, part.column("doc_id"), *place)
        best.cut()
        for item, score, ids, file, at in best.held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), ids.cast(ids_type), pa.array(file), pa.array(at), pa.array(score)],
                ["item", "doc_id", "file", "at", "score"],
            )

    schema = f"item int, doc_id {kind}, file bigint, at bigint, score bigint"
    ranks = Window.partitionBy("item").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "file", "at"
    )
    found = counts.mapInArrow(run, schema).withColumn("rank", F.row_number().over(ranks))
    return found.where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    *,
    block_items: int = BLOCK_ITEMS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of each item.

    A term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and adds, once an item however often
    it comes there, its weight times ``(10^9 tf) div (1000 tf + 20 m)``, where ``m`` is
    ``50 + (50 n N) div L``.  Documents with score 0 are not ranked; ties go to the smaller
    doc_id (null last), then to the place in the files.  Null and blank texts have no terms and
    don't count in N.  Every row of ``items`` is an item of its own, repeated ids and texts
    too; items without terms have no rows.  Empty tables give an empty result.

    Items are taken in blocks of about ``block_items``; each block passes over the documents
    once.  A task sends on at most ``k`` rows an item.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = located(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")))
    asked = asked.select("row.item_id", "file", "at", distinct_terms(F.col("row.text")).alias("terms"))
    asked = materialize(asked.where(F.size("terms") > 0), "items")
    blocks = -(-asked.count() // block_items)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = located(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    rows = rows.select("row.doc_id", "row.text", "file", "at")
    found = spark.createDataFrame([], f"item_id {asked.schema['item_id'].dataType.simpleString()}, rank int, doc_id {kind}, score bigint")
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("file", "at"), F.lit(blocks)) == block)
        found = found.unionByName(_block(rows, mine.orderBy("file", "at"), k))
    return found


def _block(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = rows.sparkSession
    block = asked.select("item_id", "terms").toArrow()
    texts = block["terms"].to_pylist()
    vocabulary = {t: i for i, t in enumerate(sorted({t for x in texts for t in x}))}
    counts = rows.select("doc_id", "file", "at", counted(F.col("text"), vocabulary).alias("c"))
    counts = materialize(counts.select("doc_id", "file", "at", "c.*").where("n > 0"), "term-counts")
    docs_n, terms_n = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[held["term"].to_numpy()] = held["count"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * docs_n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    shared = Shared([[vocabulary[t] for t in x] for x in texts], len(vocabulary))
    best = _ranked(counts, shared, weights, (docs_n, max(1, terms_n)), k)
    names = pa.table({"item": pa.array(range(len(block)), pa.int32()), "item_id": block["item_id"]})
    # At most block_items rows: a broadcast.
    return best.join(F.broadcast(spark.createDataFrame(names)), "item").select("item_id", "rank", "doc_id", "score")
