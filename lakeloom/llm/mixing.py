"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

A source's documents lie in hashed blocks.  Its target in words says how often each block is
drawn: a number of whole rounds, and in a last round a prefix of the permuted blocks.  The
draws of all sources are dealt to output shards as counts first: from the root down, each node
splits its vector of draws per source between its two halves of the shards by one multivariate
hypergeometric draw, which is what dealing out a random permutation of all draws would give.
Each shard then takes its own run of every source's permuted draws, so shards are disjoint and
the counts exact, and is put into random order on its own.  Only counts pass through the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACES, small
from lakeloom.shared import materialize

#: Weights of the sources in order, over and over.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and the most a source gives, in times its words.
SHARE, MOST = 1.5, 2.0
#: A source has a block for so many documents, up to RESOLUTION blocks of RESOLUTION units.
DOCUMENTS_A_BLOCK, RESOLUTION = 64, 4096
SHARDS = 16


def words(text: Column) -> Column:
    """Runs of other characters than white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACES.replace("[", "[^", 1))), F.lit(0)).cast(
        "bigint"
    )


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _uniform(*of: Column) -> Column:
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)


def sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Per source its number, words, target, whole rounds and the words of the last round.

    Sources are numbered by code point, null last.  Shares by weight are filled like vessels
    of size ``MOST`` times a source's words: the level at which the full ones leave over just
    what the others take.
    """
    found = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    number = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("full_at", "ord")
    everything = Window.partitionBy()
    first = F.struct("full_at", "ord", "level")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("ord") % len(weights) + 1)
    levels = (
        found.withColumn("ord", F.row_number().over(number) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("most", F.col("words") * F.lit(MOST))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("all_words", F.sum("words").over(everything) * F.lit(share))
        .withColumn(
            "full", F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        )
        .withColumn("open", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all_words") - F.col("full")) / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), first)).over(everything)["level"])
    )
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    rounds = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(1)
    blocks = F.least(F.lit(RESOLUTION), F.ceil(F.col("docs") / DOCUMENTS_A_BLOCK))
    return (
        levels.withColumn("target", target)
        .withColumn("rounds", rounds.cast("int"))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("words"))
        .withColumn("blocks", blocks.cast("int"))
        .select("ord", "source", F.col("words").alias("source_size"), "target", "rounds", "rest", "blocks")
    )


def _drawn(everyone: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``everyone`` are among the ``marked``: the hypergeometric
    quantile of ``u``.  Weights follow from one another by ratios, in logarithms."""
    low = F.greatest(F.lit(0), draws - (everyone - marked)).cast("bigint")
    high = F.least(draws, marked).cast("bigint")

    def state(log: Column, value: Column, pick: Column) -> Column:
        return F.struct(log.alias("log"), value.alias("value"), pick.alias("pick"))

    def over(span: Column) -> Column:
        def step(k: Column) -> Column:
            up = F.log((marked - k).cast("double")) + F.log((draws - k).cast("double"))
            rest = everyone - marked - draws + k + 1
            down = F.log((k + 1).cast("double")) + F.log(rest.cast("double"))
            return F.when(k < span["high"], up - down).otherwise(0.0)

        support = F.sequence(span["low"], span["high"])
        start = state(F.lit(0.0), F.lit(0.0), span["low"])

        def run(value, pick=lambda b, k: b["pick"]) -> Column:
            return F.aggregate(
                support, start, lambda b, k: state(b["log"] + step(k), value(b), pick(b, k))
            )

        def summed(top: Column) -> Column:
            def add(b: Column) -> Column:
                return b["value"] + F.exp(b["log"] - top)

            def found(total: Column) -> Column:
                def pick(b: Column, k: Column) -> Column:
                    return F.when(b["value"] < u * total, k).otherwise(b["pick"])

                return run(add, pick)["pick"]

            return _let(run(add)["value"], found)

        return _let(run(lambda b: F.greatest(b["value"], b["log"]))["value"], summed)

    return _let(F.struct(low.alias("low"), high.alias("high")), over)


def split_counts(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, ord, n): the counts (ord, draws) of all sources dealt to ``shards`` shards.

    Shards get equal numbers of draws, up to one.  A node's draw goes source by source: of the
    draws still to be made, how many fall to this source rather than to those after it.
    """
    vector = F.sort_array(F.collect_list(F.struct("ord", F.col("draws").cast("bigint").alias("n"))))
    nodes = counts.agg(vector.alias("counts")).select(
        F.lit(0).alias("low"),
        F.lit(shards).alias("high"),
        "counts",
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c["n"]).alias("all"),
    )

    def up_to(shard: Column) -> Column:
        return F.floor(F.col("all") * shard / shards).cast("bigint")

    for _ in range(max(0, shards - 1).bit_length()):
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")

        def deal(a: Column, c: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("low"), F.col("high"), c["ord"])
            draw = _drawn(a["everyone"], c["n"], a["draws"], u)
            return _let(
                draw,
                lambda k: F.struct(
                    (a["draws"] - k).alias("draws"),
                    (a["everyone"] - c["n"]).alias("everyone"),
                    F.concat(
                        a["left"], F.array(F.struct(c["ord"].alias("ord"), k.alias("n")))
                    ).alias("left"),
                ),
            )

        node_all = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
        start = F.struct(
            (up_to(F.col("middle")) - up_to(F.col("low"))).alias("draws"),
            node_all.alias("everyone"),
            F.array().cast("array<struct<ord:int,n:bigint>>").alias("left"),
        )
        right = F.zip_with(
            "counts", "left", lambda c, d: F.struct(c["ord"].alias("ord"), (c["n"] - d["n"]).alias("n"))
        )
        halves = F.when(
            F.col("high") - F.col("low") > 1,
            F.array(
                F.struct("low", F.col("middle").alias("high"), F.col("left").alias("counts")),
                F.struct(F.col("middle").alias("low"), "high", right.alias("counts")),
            ),
        ).otherwise(F.array(F.struct("low", "high", "counts")))
        nodes = (
            nodes.withColumn("middle", middle)
            .withColumn("left", F.aggregate("counts", start, deal)["left"])
            .select("all", F.explode(halves).alias("half"))
            .select("all", "half.*")
        )
    return nodes.select(F.col("low").alias("shard"), F.explode("counts").alias("c")).select(
        "shard", "c.ord", "c.n"
    )


def _placed(frame: DataFrame, found: DataFrame) -> DataFrame:
    """Adds what ``found`` says of each row's source, and its block and unit."""
    known = small(found).withColumnRenamed("source", "known_source")
    return (
        frame.join(known, F.col("source").eqNullSafe(F.col("known_source")))
        .withColumn("block", F.pmod("h", "blocks").cast("int"))
        .withColumn("unit", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(RESOLUTION)).cast("int"))
    )


def plan(sized: DataFrame, shards: int = SHARDS, seed: int = 0, **options) -> tuple[DataFrame, ...]:
    """The written tables of a mix of ``sized`` (source, size, h): sources, blocks with the
    shards of their draws, and the drawn units of the blocks that are drawn in part."""
    found = materialize(sources(sized, **options), "mix-sources")
    placed = _placed(sized, found)
    by_source = Window.partitionBy("ord")
    permuted = by_source.orderBy(F.xxhash64(F.lit(seed), "ord", "block"), "block")
    cum = F.sum("size").over(permuted.rowsBetween(Window.unboundedPreceding, 0))
    blocks = materialize(
        placed.groupBy("ord", "block", "rounds", "rest")
        .agg(F.sum("size").alias("size"))
        .withColumn("before", cum - F.col("size"))
        .withColumn("whole", F.col("before") + F.col("size") <= F.col("rest"))
        .withColumn("part", ~F.col("whole") & (F.col("before") < F.col("rest"))),
        "mix-blocks",
    )
    # The block that the last round ends in: units up to its end, then the one that fits best.
    edge = blocks.where("part").select("ord", "block", (F.col("rest") - F.col("before")).alias("gap"))
    order = by_source.orderBy(F.xxhash64(F.lit(seed), "ord", "unit"), "unit")
    cum = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    units = (
        placed.select("ord", "block", "unit", "size")
        .join(small(edge), ["ord", "block"])
        .groupBy("ord", "block", "gap", "unit")
        .agg(F.sum("size").alias("size"))
        .withColumn("fits", cum <= F.col("gap"))
        .withColumn(
            "open",
            F.col("gap") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))).over(by_source), F.lit(0)),
        )
        .withColumn("off", F.abs(F.col("size") - F.col("open")))
    )
    best = F.row_number().over(by_source.orderBy("fits", "off", "unit")) == 1
    units = materialize(
        units.withColumn("best", best & ~F.col("fits") & (F.col("off") < F.col("open")))
        .where("fits or best")
        .select("ord", "block", "unit"),
        "mix-units",
    )
    draws = blocks.select(
        "ord",
        "block",
        F.explode(F.sequence(F.lit(0), F.col("rounds"))).alias("round"),
        "rounds",
        "whole",
        "part",
    ).where("round < rounds or whole or part")
    draws = draws.withColumn(
        "place",
        F.row_number().over(by_source.orderBy(F.xxhash64(F.lit(seed), "ord", "block", "round"), "block", "round")) - 1,
    )
    counts = draws.groupBy("ord").agg(F.count("*").alias("draws"))
    dealt = split_counts(counts, shards, seed).where("n > 0")
    start = F.sum("n").over(by_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    dealt = dealt.withColumn("start", start).select(
        "ord", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("place")
    )
    full = F.col("round") < F.col("rounds")
    drawn = (
        draws.join(dealt, ["ord", "place"])
        .groupBy("ord", "block")
        .agg(
            F.sort_array(F.collect_list(F.when(full | F.col("whole"), F.col("shard")))).alias("full_shards"),
            F.max(F.when(~full & F.col("part"), F.col("shard"))).alias("part_shard"),
        )
    )
    return found, materialize(drawn, "mix-draws"), units


def assign(frame: DataFrame, tables: tuple[DataFrame, ...]) -> DataFrame:
    """``frame`` (source, h and more) with ``source_size``, ``target`` and ``shards``: the
    shard of each time the row is drawn."""
    found, drawn, units = tables
    taken = small(units.withColumn("drawn", F.lit(True)))
    part = F.when(F.col("drawn") & F.col("part_shard").isNotNull(), F.array("part_shard"))
    shards = F.concat(
        F.coalesce("full_shards", F.array().cast("array<int>")),
        F.coalesce(part, F.array().cast("array<int>")),
    )
    return (
        _placed(frame, found)
        .join(small(drawn), ["ord", "block"], "left")
        .join(taken, ["ord", "block", "unit"], "left")
        .withColumn("shards", shards)
        .drop("known_source", "ord", "block", "unit", "rounds", "rest", "blocks", "drawn")
        .drop("full_shards", "part_shard")
    )


def sized(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` and the hash ``h`` that places a row."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        words(F.col(text)).alias("size"),
        F.xxhash64(doc_id, text).alias("h"),
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per document ``size``, ``source_size``, ``target`` (of its source), ``shards`` and
    ``taken``: the words the mix takes of it, every repetition counted.

    A null text has no words; a null source is a source of its own, the last.  Repeated rows
    are drawn together.  Sources without a word have the target 0, and their documents are
    drawn once.  An empty table gives an empty result.
    """
    rows = materialize(sized(docs), "mix-sizes")
    mixed = assign(rows, plan(rows, **options))
    return mixed.withColumn("taken", F.col("size") * F.size("shards")).drop("h", "source")


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0, **options) -> DataFrame:
    """``row`` (the columns of ``docs``), once for each draw, with its ``shard``; partitioned
    by shard, and in a random order that reruns repeat within each."""
    rows = materialize(sized(docs), "mix-sizes")
    tables = plan(rows, shards, seed, **options)
    full = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.source").alias("source"), F.xxhash64("row.doc_id", "row.text").alias("h")
    )
    drawn = assign(full, tables).select("row", "h", F.posexplode("shards").alias("draw", "shard"))
    order = F.xxhash64(F.lit(seed), "h", "draw")
    return (
        drawn.withColumn("order", order)
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "order")
        .select("row", "shard")
    )
