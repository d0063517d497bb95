"""Windows over hot keys in segments, against plain windows."""

import random

import pytest
from lakeloom.operators import segments
from pyspark.sql import Window
from pyspark.sql import functions as F


def plain(df):
    ordered = Window.partitionBy("k").orderBy("o")
    changed = F.when(F.lag("v").over(ordered) != F.col("v"), 1).otherwise(0)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("c", changed).select("k", "o", "v", F.sum("c").over(running).alias("group_id"))


@pytest.mark.parametrize("kind", ["int", "date", "timestamp", "string"])
@pytest.mark.parametrize("rows", [3, 40, 10_000])
def test_groups_are_those_of_a_window(spark, kind, rows):
    rng = random.Random(rows)
    data = [(k, o, rng.choice(["a", "b", None])) for k in ("hot", None, "x", "y") for o in range(300 if k in ("hot", None) else 4)]
    df = spark.createDataFrame(rng.sample(data, len(data)), "k string, o int, v string")
    order = {
        "int": F.col("o"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("o")),
        "timestamp": F.timestamp_seconds(F.col("o") * 7), "string": F.lpad(F.col("o").cast("string"), 5, "0"),
    }[kind]
    df = df.withColumn("o", order)
    found = segments.change_groups(df, ["k"], "o", "v", segment_rows=rows)
    assert found.columns == ["k", "o", "v", "group_id"]
    key = lambda r: (str(r.k), str(r.o))
    assert sorted(found.collect(), key=key) == sorted(plain(df).collect(), key=key)


def test_null_orders_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 1, "y"), ("a", 2, "y"), ("a", 3, "x")], "k string, o int, v string")
    got = segments.change_groups(df, ["k"], "o", "v", segment_rows=1).orderBy("o").collect()
    assert [r.group_id for r in got] == [0, 1, 1, 2]
    assert segments.change_groups(df.limit(0), ["k"], "o", "v").count() == 0


def test_a_hot_key_is_many_tasks(spark):
    """A third of all rows have one key; no segment has more than twice its share."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(90_000).select(hot.alias("k"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    cut = segments.segmented(df, ["k"], "o", 1000)
    sizes = [r[0] for r in cut.groupBy("k", segments.SEGMENT).count().where("k = 0").select("count").collect()]
    assert sum(sizes) == 30_000 and len(sizes) >= 25 and max(sizes) <= 2000
    assert cut.where("k <> 0").agg(F.max(segments.SEGMENT)).first()[0] == 0
