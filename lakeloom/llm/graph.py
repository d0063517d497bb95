"""Groups of linked ids: links found inside buckets, and connected components of links.

Everything is a join or an aggregate over written tables, so no group is ever held by a task
and lost executors cost no more than their own tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import gathered, small
from lakeloom.shared import materialize

#: Rounds in which the members of a bucket are held against one of them.
ROUNDS = 2


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) of every id on an edge; ``root`` is the smallest id of its component.

    Large and small stars take turns until nothing changes: every id is linked to the smallest
    of its neighbours, once for the larger and once for the smaller ones.
    """
    edges = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges = gathered(materialize(edges.where("hi <> lo").distinct(), "edges"))
    before = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = gathered(materialize(large.where("hi <> lo").distinct(), "edges"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small_star = (
            large.join(least, "hi")
            .select(F.explode(F.array(F.struct(F.col("lo").alias("u"), "m"), F.struct(F.col("hi").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("hi"), F.col("e.m").alias("lo"))
        )
        edges = gathered(materialize(small_star.where("hi <> lo").distinct(), "edges"))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("lo").distinct().select(F.col("lo").alias("id"), F.col("lo").alias("root"))
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root")).union(roots)


def linked(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    possible: Callable[[Column, Column], Column],
    central: str = "0",
    rounds: int = ROUNDS,
    buckets: DataFrame | None = None,
) -> DataFrame:
    """(id, root) of the ids that are linked to others.

    ``members`` (bucket, id, info) is a written table; ids of one bucket are candidates of each
    other.  ``possible`` of the infos of two is false only where no link can be; ``verify``
    keeps the true links of pairs (a, b).  The result is what verifying all candidates would
    give, but pairs inside a component need not be looked at.  First, in a few rounds, the
    members of a bucket are held against one of them, the first by the SQL expression
    ``central`` of its info, in later rounds any one of the largest component: this joins
    groups of copies at a cost in proportion to their size.  Then every possible pair that still
    lies in two components is verified, unless an earlier round has; with ``buckets`` (id, buckets: all buckets of the id)
    it is made in one bucket, the least that the two share, and not in each.
    """
    links, known, done = None, None, None
    members = gathered(members)
    rank = F.expr(central).alias("rank")
    for turn in range(rounds + 1):
        if known is None:
            placed = members.withColumn("root", F.col("id"))
        else:
            root = F.coalesce("root", "id").alias("root")
            placed = members.join(known, "id", "left").select("bucket", "id", "info", root)
            roots = placed.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
            # The first round has seen the one pair of two.
            torn = roots.where("r0 <> r1 and n > 2").select("bucket")
            placed = gathered(materialize(placed.join(torn, "bucket"), "torn"))
            # Components only grow: a bucket that lies in one stays there.
            members = placed.drop("root")
        if placed.isEmpty():
            break
        # The most central id of each component in a bucket; the largest component is the main.
        place = rank if turn == 0 else F.lit(0).alias("rank")
        first = F.struct(place, F.xxhash64(F.lit(turn), "id").alias("h"), "id", "info")
        parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.min(first).alias("first"))
        parts = parts.withColumn("order", F.struct("n", F.negative("first.rank"), "root", "first"))
        main = parts.groupBy("bucket").agg(F.max("order").alias("main"))
        if turn < rounds:
            others = main.select(
                "bucket",
                F.col("main.first.id").alias("other"),
                F.col("main.first.info").alias("other_info"),
                F.col("main.root").alias("other_root"),
            )
            free = F.col("root") != F.col("other_root")
        else:
            if buckets is not None:
                placed = materialize(placed.join(buckets, "id"), "placed")
            few = placed.join(main.select("bucket", F.col("main.root").alias("main")), "bucket")
            others = few.where("root <> main").select(
                "bucket",
                "main",
                F.col("id").alias("other"),
                F.col("info").alias("other_info"),
                F.col("root").alias("other_root"),
                *([F.col("buckets").alias("other_buckets")] if buckets is not None else []),
            )
            free = F.expr("root <> other_root and (root = main or id < other)")
            if buckets is not None:
                free &= F.array_min(F.array_intersect("buckets", "other_buckets")) == F.col("bucket")
        free &= possible(F.col("info"), F.col("other_info"))
        pairs = placed.join(others, "bucket").where(free)
        pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        pairs = pairs.distinct()
        if done is not None:
            pairs = pairs.join(small(done), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        done = pairs if done is None else done.union(pairs)
        found = materialize(verify(pairs).select("a", "b"), "links")
        links = found if links is None else links.union(found)
        if found.isEmpty() and turn < rounds:
            continue
        known = gathered(materialize(components(links), "components"))
    if known is None:
        return members.select("id", F.col("id").alias("root")).limit(0)
    return known


def shared_buckets(rows: DataFrame) -> DataFrame:
    """The rows (bucket, id, ...) whose bucket holds several of them, as a written table; counts
    go through the shuffle before ids do."""
    several = rows.groupBy("bucket").count().where("count > 1").select("bucket")
    several = materialize(several, "buckets")
    return materialize(rows.join(small(several), "bucket"), "members")
