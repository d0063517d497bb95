"""Key buckets, records beside tables, and what an update leaves alone."""

import datetime as dt
import os
from pathlib import Path

import pytest
from lakeloom.operators import history, keys
from lakeloom.plans import gold, silver
from lakeloom.roles import DimensionRoles, HistoryRoles, SilverRoles
from lakeloom.sources import buckets, compaction, files, records, sinks
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def data_files(folder):
    """Data files by folder."""
    found = {}
    for f in Path(folder).rglob("*.parquet"):
        found.setdefault(str(f.parent.relative_to(folder)), set()).add(f.name)
    return found


def roles(key, partition=()):
    names = ["k", "v", "p"]
    return SilverRoles.parse(
        [
            {"expression": c, "column_type": "int" if c == "k" else "string", "column_name": c,
             "column_order": i, "is_output": 1, key: int(c == "k"), "is_partition_by": int(c in partition)}
            for i, c in enumerate(names)
        ]
    )


def bronze(spark, path, stamp, values):
    df = spark.createDataFrame([(str(k), v, p, stamp) for k, v, p in values], "k string, v string, p string, partition string")
    df.write.mode("append").partitionBy("partition").parquet(path)


@pytest.mark.parametrize("method, key", [("pk_merge", "is_primary_key"), ("bk_merge", "is_batch_key")])
@pytest.mark.parametrize("partition", [(), ("p",)])
def test_merges_leave_other_buckets_alone(spark, path, method, key, partition):
    role = roles(key, partition)
    first = [(k, "old", "x" if k % 2 else "y") for k in range(200)]
    bronze(spark, path("b"), "1", first)
    mark = silver.update_silver(spark, path("b"), path("s"), role, method, buckets=16)
    before = data_files(path("s"))
    # One key changes and moves to another partition, one is new.
    bronze(spark, path("b"), "2", [(7, "new", "y"), (1000, "new", "z")])
    silver.update_silver(spark, path("b"), path("s"), role, method, mark=mark, inclusive=False, buckets=16)
    table = files.read_table(spark, path("s"))
    expected = [r for r in first if r[0] != 7] + [(7, "new", "y"), (1000, "new", "z")]
    assert rows(table.select("k", "v", "p")) == sorted(expected, key=repr)
    assert table.columns == ["k", "v", "p"]
    after = data_files(path("s"))
    changed = {f.split("/")[0] for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert 1 <= len(changed) <= 2 and len({f.split("/")[0] for f in after}) == 16


def test_the_last_row_of_a_folder_leaves_it(spark, path):
    role = roles("is_primary_key", ["p"])
    bronze(spark, path("b"), "1", [(1, "a", "x"), (2, "a", "y")])
    mark = silver.update_silver(spark, path("b"), path("s"), role, "pk_merge", buckets=1)
    bronze(spark, path("b"), "2", [(1, "b", "y")])
    silver.update_silver(spark, path("b"), path("s"), role, "pk_merge", mark=mark, inclusive=False, buckets=1)
    assert rows(files.read_table(spark, path("s")).select("k", "v", "p")) == [(1, "b", "y"), (2, "a", "y")]


def test_tables_get_buckets_by_their_first_merge_and_more_when_they_grow(spark, path, monkeypatch):
    role = roles("is_primary_key")
    df = spark.createDataFrame([(k, "old", "x") for k in range(50)], "k int, v string, p string")
    df.write.parquet(path("s"))
    update = spark.createDataFrame([(3, "new", "x")], df.schema)
    silver.write_silver(update, path("s"), role, "pk_merge")
    assert records.read_record(spark, path("s"))["buckets"] == buckets.LEAST
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 1000)
    silver.write_silver(update, path("s"), role, "pk_merge")
    assert records.read_record(spark, path("s"))["buckets"] > buckets.LEAST
    # Keys of another type hash otherwise, so the table is laid out anew.
    wide = update.withColumn("k", F.col("k").cast("bigint"))
    silver.write_silver(wide, path("s"), role, "pk_merge")
    assert records.read_record(spark, path("s"))["bucket_keys"] == [["k", "bigint"]]
    got = rows(files.read_table(spark, path("s")).select("k", "v"))
    assert got == sorted([(k, "new" if k == 3 else "old") for k in range(50)], key=repr)


def test_null_and_zero_keys(spark, path):
    role = roles("is_batch_key")
    df = spark.createDataFrame([(None, "null", "x"), (0, "old", "x"), (5, "old", "x")], "k int, v string, p string")
    sinks.overwrite_buckets(df, path("s"), ["k"], 8)
    update = spark.createDataFrame([(0, "new", "x"), (None, "dropped", "x")], df.schema)
    silver.write_silver(update, path("s"), role, "bk_merge")
    assert rows(files.read_table(spark, path("s")).select("k", "v")) == [(0, "new"), (5, "old"), (None, "null")]
    silver.write_silver(update.limit(0), path("s"), role, "bk_merge")
    assert files.read_table(spark, path("s")).count() == 3


def test_dimension_updates_leave_other_buckets_alone(spark, path):
    role = DimensionRoles(("k",), "sk", ("stamp",))
    schema = "k string, v string, stamp string"
    first = [(f"k{i:03}", "old", "1") for i in range(100)]
    spark.createDataFrame(first, schema).write.parquet(path("s"))
    gold.update_dimension_table(spark, path("s"), path("d"), role, "stamp", buckets=16)
    before = data_files(path("d"))
    assert records.read_record(spark, path("d"))["highest"] == 100
    spark.createDataFrame([("k007", "new", "2"), ("new", "new", "2")], schema).write.mode("append").parquet(path("s"))
    gold.update_dimension_table(spark, path("s"), path("d"), role, "stamp", "2", buckets=16)
    after = data_files(path("d"))
    assert sum(before.get(f) == after.get(f) for f in after) >= 14
    got = rows(files.read_table(spark, path("d")).select("k", "v", "sk"))
    expected = [(k, "new" if k == "k007" else v, i + 1) for i, (k, v, _) in enumerate(first)]
    assert got == sorted([*expected, ("new", "new", 101)], key=repr)
    with pytest.raises(ValueError):
        spark.createDataFrame([("z", "1", "3", "odd")], schema + ", odd string").write.parquet(path("odd"))
        gold.update_dimension_table(spark, path("odd"), path("d"), role)


HISTORY = HistoryRoles(("id",), ("name",), "day", "vf", "vt", "cur", "hash", "sk")


def days(spark, path, day, states):
    df = spark.createDataFrame([(k, v, dt.date(2024, 1, day)) for k, v in states.items()], "id int, name string, day date")
    df.write.mode("append").partitionBy("day").parquet(path)


def test_one_changed_key_rewrites_one_bucket_of_a_history(spark, path):
    states = {i: "a" for i in range(100)}
    days(spark, path("s"), 1, states)
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, buckets=16)
    before = data_files(path("h"))
    days(spark, path("s"), 2, states | {42: "b"})
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
    after = data_files(path("h"))
    changed = [f for f in before if before[f] != after.get(f)]
    assert len(changed) == 1 and after.keys() - before.keys() == {"vt=2024-01-02/key_bucket=closed"}
    assert records.read_record(spark, path("h"))["highest"] == 101
    # Nothing new: nothing is written.
    gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
    assert data_files(path("h")) == after


def test_a_bucket_all_of_whose_keys_end_is_empty(spark, path):
    days(spark, path("s"), 1, {1: "a", 2: "a", 3: "a"})
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, buckets=1)
    days(spark, path("s"), 2, {9: "b"})
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
    days(spark, path("s"), 3, {1: "a"})
    # A lost record costs a rewrite, nothing else.
    Path(path("h"), records.NAME).unlink()
    gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark, buckets=2)
    assert records.read_record(spark, path("h"))["buckets"] == 2
    table = files.read_table(spark, path("h"))
    got = rows(table.select("id", F.day("vf"), F.day("vt"), "cur", "sk"))
    assert got == [(1, 1, 2, False, 1), (1, 3, 31, True, 5), (2, 1, 2, False, 2), (3, 1, 2, False, 3), (9, 2, 3, False, 4)]


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_a_history_of_all_days(spark, path, seed):
    import random

    rng = random.Random(seed)
    mark, everything, present = None, [], {}
    for day in range(1, 8):
        for k in range(12):
            if rng.random() < 0.3:
                present[k] = rng.choice("ab")
            if rng.random() < 0.15:
                present.pop(k, None)
        present = present or {0: "a"}
        days(spark, path("s"), day, present)
        everything += [(k, v, dt.date(2024, 1, day)) for k, v in present.items()]
        mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark, buckets=4)
    whole = spark.createDataFrame(everything, "id int, name string, day date")
    expected = history.build_history(whole, HISTORY, close_missing=True)
    columns = ["id", "name", "vf", "vt", "cur"]
    found = files.read_table(spark, path("h"))
    assert rows(found.select(*columns)) == rows(expected.select(*columns))
    assert rows(found.select("sk")) == [(i + 1,) for i in range(expected.count())] or found.select("sk").distinct().count() == expected.count()


def test_the_highest_key_is_read_from_the_record(spark, path):
    df = spark.createDataFrame([(5, "a"), (9, "b")], "sk bigint, v string")
    sinks.overwrite(df, path("t"))
    assert gold.highest_key(spark, path("t"), "sk") == 9
    records.write_record(spark, path("t"), highest=40)
    assert gold.highest_key(spark, path("t"), "sk") == 40
    with pytest.raises(RuntimeError), records.rewriting(spark, path("t"), "highest"):
        raise RuntimeError
    # What a failed change has left is not believed.
    assert gold.highest_key(spark, path("t"), "sk") == 9
    Path(path("t"), records.NAME).write_text("{torn")
    for crc in Path(path("t")).glob(".*crc"):
        if records.NAME in crc.name:
            crc.unlink()
    assert records.read_record(spark, path("t")) == {}
    assert keys.max_surrogate(files.read_table(spark, path("t")), "sk").first()[0] == 9


def test_schemas_are_kept_with_the_table(spark, path):
    one = spark.createDataFrame([(1, 1.5, "p1")], "a int, f float, p string")
    two = spark.createDataFrame([(2**40, "x", "p1")], "a bigint, b string, p string")
    sinks.append_evolve(one, path("t"), ["p"])
    sinks.append_evolve(two, path("t"), ["p"])
    sinks.append_evolve(one.drop("f"), path("t"), ["p"])
    # The newest file is not the one that knows all columns, and times tell nothing.
    for f in Path(path("t")).rglob("*"):
        os.utime(f, (1, 1))
    for table in (files.read_table(spark, path("t"), evolved=True), files.read_stamped(spark, path("t"), "p")):
        assert dict(table.dtypes) == {"a": "bigint", "f": "float", "b": "string", "p": "string"}
        assert rows(table.select("a", "f", "b")) == [(1, 1.5, None), (1, None, None), (2**40, None, "x")]
    with pytest.raises(TypeError):
        sinks.append_evolve(spark.createDataFrame([("text", "p1")], "a string, p string"), path("t"), ["p"])


def test_wider_types():
    def merged(a, b):
        kinds = [StructType.fromDDL(f"c {x}") for x in (a, b)]
        return records.merged_schema(*kinds)["c"].dataType.simpleString()

    assert merged("tinyint", "int") == "int" and merged("bigint", "int") == "bigint"
    assert merged("float", "double") == "double" and merged("int", "double") == "double"
    assert merged("decimal(10,2)", "decimal(8,4)") == "decimal(12,4)"
    for a, b in (("string", "int"), ("bigint", "double"), ("decimal(38,0)", "decimal(38,10)"), ("date", "timestamp")):
        with pytest.raises(TypeError):
            merged(a, b)


def test_compaction_leaves_whole_partitions_alone(spark, path):
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("whole").alias("p"))
    df.coalesce(1).write.partitionBy("p").parquet(path("t"))
    pieces = spark.range(90).select("id", F.lit("x").alias("v"), F.when(F.col("id") % 3 > 0, F.lit("cut")).alias("p"))
    pieces.repartition(9).write.mode("append").partitionBy("p").parquet(path("t"))
    records.write_record(spark, path("t"), highest=7)
    before = data_files(path("t"))
    assert compaction.compact_in_place(spark, path("t"), file_bytes=8000) == 18
    after = data_files(path("t"))
    assert after["p=whole"] == before["p=whole"]
    null = "p=__HIVE_DEFAULT_PARTITION__"
    assert len(after["p=cut"]) < len(before["p=cut"]) and len(after[null]) < len(before[null])
    table = spark.read.parquet(path("t"))
    assert table.count() == 4090 and table.where("p is null").count() == 30
    assert compaction.compact_in_place(spark, path("t"), file_bytes=100) == 0
    assert data_files(path("t")) == after and records.read_record(spark, path("t")) == {"highest": 7}


def test_compaction_keeps_layout_and_record(spark, path):
    role = roles("is_primary_key", ["p"])
    bronze(spark, path("b"), "1", [(k, "old", "x") for k in range(40)])
    mark = silver.update_silver(spark, path("b"), path("s"), role, "pk_merge", buckets=2)
    extra = spark.createDataFrame([(1000 + k, "app", "x") for k in range(20)], "k int, v string, p string")
    laid = buckets.with_bucket(extra, ["k"], 2).repartition(5)
    laid.write.mode("append").partitionBy(buckets.BUCKET, "p").parquet(path("s"))
    record = records.read_record(spark, path("s"))
    sinks.compact(spark, path("s"), path("s"))
    assert records.read_record(spark, path("s")) == record
    assert all(len(f) == 1 for f in data_files(path("s")).values())
    bronze(spark, path("b"), "2", [(3, "new", "x")])
    silver.update_silver(spark, path("b"), path("s"), role, "pk_merge", mark=mark, inclusive=False)
    table = files.read_table(spark, path("s"))
    assert table.count() == 60 and rows(table.where("k = 3").select("v")) == [("new",)]


def test_compaction_gives_each_task_one_bin(spark, path):
    rows_ = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 7).alias("p"))
    rows_.repartition(4).write.partitionBy("p").parquet(path("t"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert compaction.compact_in_place(spark, path("t"), file_bytes=40_000) == 28
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files_ = data_files(path("t"))
    # No task has written two bins.
    tasks = [f.split("-")[1] for names in files_.values() for f in names]
    assert len(set(tasks)) == len(tasks)
    assert rows(spark.read.parquet(path("t")).select("id", "v", "p")) == rows(rows_)
