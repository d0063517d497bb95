from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import maintenance
from lakeloom.sources import files, landing, sinks, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def part_files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_landing_appends_by_stamp(spark, path):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x", "b": {"c": true}}',)], ["doc"])
    landing.land_text(df, path("l"), stamp="20250101000000")
    landing.land_text(df.limit(1), path("l"), stamp="20250201000000")
    landed = files.read_json_files(spark, path("l"), "partition")
    assert dict(landed.dtypes) == {"a": "string", "b": "struct<c:string>", "partition": "string"}
    assert rows(landed.groupBy("partition").count()) == [("20250101000000", 2), ("20250201000000", 1)]


def test_stamp_of_the_run(spark, path):
    landing.land_rows(spark.range(2), path("l"))
    (stamp,) = {r.partition for r in files.read_parquet_files(spark, path("l"), "partition").collect()}
    assert len(stamp) == 14 and stamp.startswith("20")


def test_multi_line_documents(spark, path):
    Path(path("m")).mkdir()
    Path(path("m"), "a.json").write_text('[\n {"a": 1},\n {"a": 2.50}\n]')
    assert rows(files.read_json_files(spark, path("m"), multi_line=True)) == [("1",), ("2.50",)]


def test_incremental_scan_reads_new_folders_only(spark, path):
    for n in (1, 2, 3):
        landing.land_text(
            spark.createDataFrame([(f'{{"c{n}": {n}}}',)], ["d"]), path("l"), stamp=f"2025010{n}000000"
        )
    since = files.read_json_files(spark, path("l"), "partition", "20250102000000")
    # The first folder's column is unknown: its files were not even opened.
    assert sorted(since.columns) == ["c2", "c3", "partition"] and since.count() == 2
    assert files.read_json_files(spark, path("l"), "partition", "20260101000000").count() == 0


def test_given_schema_saves_inference(spark, path):
    landing.land_text(spark.createDataFrame([('{"a": 1}',)], ["d"]), path("l"), stamp="20250101000000")
    df = files.read_json_files(spark, path("l"), "partition", schema="a string, z string, partition string")
    assert rows(df) == [("1", None, "20250101000000")]


def test_parquet_schemas_merge(spark, path):
    landing.land_rows(spark.range(1).withColumn("a", F.lit("x")), path("l"), stamp="1")
    landing.land_rows(spark.range(1).withColumn("b", F.lit("y")), path("l"), stamp="2")
    df = files.read_parquet_files(spark, path("l"), "partition")
    assert rows(df.select("id", "a", "b", "partition")) == [(0, "x", None, "1"), (0, None, "y", "2")]


def test_table_exists(spark, path):
    assert not files.table_exists(spark, path("t"))
    sinks.overwrite(spark.range(1), path("t"))
    assert files.table_exists(spark, path("t"))


def test_overwrite_changes_schema_and_may_read_its_target(spark, path):
    sinks.overwrite(spark.range(3), path("t"))
    sinks.overwrite(spark.createDataFrame([("a", 1)], "k string, p int"), path("t"), ["p"])
    held = files.read_table(spark, path("t"))
    assert rows(held) == [("a", 1)]
    sinks.overwrite(held.withColumn("k", F.lit("b")), path("t"), ["p"], reads_target=True)
    assert rows(files.read_table(spark, path("t"))) == [("b", 1)]


def test_overwrite_partitions_leaves_others(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.overwrite(df, path("t"), ["p"])
    held = files.read_table(spark, path("t"))
    sinks.overwrite_partitions(held.filter("p = 'a'").withColumn("v", F.col("v") + 10), path("t"), ["p"])
    assert rows(files.read_table(spark, path("t"))) == [(11, "a"), (2, "b")]


def test_append_strict_refuses_strange_columns(spark, path):
    df = spark.createDataFrame([(1, "a")], "v int, p string")
    sinks.append_strict(df, path("t"), ["p"])
    sinks.append_strict(df, path("t"), ["p"])
    assert files.read_table(spark, path("t")).count() == 2
    with pytest.raises(ValueError):
        sinks.append_strict(df.withColumn("z", F.lit(1)), path("t"), ["p"])
    with pytest.raises(TypeError):
        sinks.append_strict(df.withColumn("v", F.lit("x")), path("t"), ["p"])


def test_append_evolve(spark, path):
    sinks.append_evolve(spark.createDataFrame([(1, 2)], "a int, b int"), path("t"))
    sinks.append_evolve(spark.createDataFrame([(3, 4)], "c int, a int"), path("t"))
    held = files.read_table(spark, path("t"), evolved=True)
    assert rows(held.select("a", "b", "c")) == [(1, 2, None), (4, None, 3)]


def test_align_columns_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["new", "B", "a"])
    assert sinks.align_columns(df, ["a", "gone", "b"]).columns == ["a", "new", "B"]


def test_replace_since_loads_the_mark_once(spark, path):
    df = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3")], "v int, p string")
    sinks.overwrite(df.filter("p <= '2'"), path("t"), ["p"])
    sinks.replace_since(df, path("t"), "p", "2")
    sinks.replace_since(df, path("t"), "p", "2")
    assert sorted(r.v for r in files.read_table(spark, path("t")).collect()) == [1, 2, 3]


def test_fixed_schema(spark, path):
    df = spark.createDataFrame([("abcdef", True, "7")], "s string, f boolean, n string")
    fitted = sinks.fit_schema(df, "n int, s varchar(3), f boolean, d decimal(10, 2), x char(2)")
    assert fitted.dtypes == [
        ("n", "int"), ("s", "string"), ("f", "boolean"), ("d", "decimal(10,2)"), ("x", "string"),
    ]
    assert rows(fitted) == [(7, "abc", True, None, None)]
    with pytest.raises(TypeError):
        sinks.fit_schema(df, "f int")


def test_compaction_writes_fewer_files(spark, path):
    df = spark.range(100).withColumn("p", F.col("id") % 2)
    df.repartition(10).write.partitionBy("p").parquet(path("t"))
    assert len(part_files(path("t"))) == 20
    sinks.compact(spark, path("t"), path("t"), ["p"])
    assert len(part_files(path("t"))) == 2
    assert files.read_table(spark, path("t")).count() == 100
    sinks.compact(spark, path("t"), path("u"))
    assert len(part_files(path("u"))) == 1


def test_inventory_and_view(spark):
    view = tables.passthrough_view(spark.range(3), "three_rows")
    assert view.count() == 3
    assert "three_rows" in {r.table_name for r in tables.table_inventory(spark).collect()}


def test_newest_stamp_knows_all_columns(spark, path):
    first = spark.createDataFrame([(1, 2, "1")], "a int, b int, p string")
    sinks.overwrite(first, path("t"), ["p"])
    second = spark.createDataFrame([(3, 4, "2")], "c int, a int, p string")
    sinks.replace_since(second, path("t"), "p", "2")
    sinks.append_evolve(spark.createDataFrame([(5, "10")], "a int, p string"), path("t"), ["p"])
    table = files.read_stamped(spark, path("t"), "p")
    assert rows(table.select("a", "b", "c")) == [(1, 2, None), (4, None, 3), (5, None, None)]
    news = files.read_stamped(spark, path("t"), "p", "2")
    assert rows(news.select("a", "b", "c")) == [(4, None, 3), (5, None, None)]
    assert all("p=1/" not in f for f in news.inputFiles())
    assert files.read_stamped(spark, path("t"), "p", "99").count() == 0


def test_permanent_view_and_catalog_compaction(spark, path):
    df = spark.range(20).withColumn("p", F.col("id") % 2)
    df.repartition(5).write.partitionBy("p").saveAsTable("small_files")
    spark.sql("create database if not exists other")
    try:
        view = tables.permanent_view(spark, "same_rows", "small_files")
        assert view.count() == 20
        before = len(spark.table("small_files").inputFiles())
        maintenance.compact_catalog_tables(spark, ["default.small_files"])
        assert rows(spark.table("small_files")) == rows(df)
        assert len(spark.table("small_files").inputFiles()) == 2 < before
        names = {r.table_name.removeprefix("spark_catalog.") for r in tables.table_inventory(spark).collect()}
        assert {"default.small_files", "default.same_rows"} <= names
        sinks.overwrite(df, path("t"))
        assert tables.permanent_view(spark, "same_rows", f"parquet.`{path('t')}`").count() == 20
    finally:
        spark.sql("drop view if exists same_rows")
        spark.sql("drop table small_files")
        spark.sql("drop database other")


def test_copies_take_declared_types(spark, path):
    source, target = path("source"), path("target")
    spark.createDataFrame([("1", "x"), ("two", None)], "id string, note string").write.parquet(source)
    sinks.copy_table(spark, source, target, types={"id": "int"})
    copied = files.read_table(spark, target)
    assert copied.schema.simpleString() == "struct<id:int,note:string>"
    assert {tuple(r) for r in copied.collect()} == {(1, "x"), (None, None)}
    with pytest.raises(ValueError, match="none"):
        sinks.copy_table(spark, source, target, types={"none": "int"})
