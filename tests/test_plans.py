import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom import shared
from lakeloom.operators import dedup, filters, history, keys, merge
from lakeloom.plans import bronze, gold, silver
from lakeloom.roles import DimensionRoles, HistoryRoles, SilverRoles
from lakeloom.sources import files, landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- bronze ---


def land(spark, path, stamp, *documents):
    landing.land_text(spark.createDataFrame([(d,) for d in documents], ["d"]), path, stamp=stamp)


def test_bronze_json_runs(spark, path):
    land(spark, path("l"), "20250101000000", '{"id": 1, "tags": [{"n.m": "a"}, {"n.m": "b"}]}')
    mark = bronze.update_from_json(spark, path("l"), path("b"))
    assert mark == "20250101000000"
    land(spark, path("l"), "20250201000000", '{"id": 2, "extra": true}')
    for _ in range(2):
        mark = bronze.update_from_json(spark, path("l"), path("b"), mark=mark)
        assert mark == "20250201000000"
        table = files.read_table(spark, path("b"), evolved=True)
        got = table.select("id", "tags_n_m", "extra", F.col("partition").cast("string"))
        assert rows(got) == [
            ("1", "a", None, "20250101000000"), ("1", "b", None, "20250101000000"),
            ("2", None, "true", "20250201000000"),
        ]
    bronze.update_from_json(spark, path("l"), path("b"), mark=mark, full_refresh=True)
    assert files.read_table(spark, path("b"), evolved=True).count() == 3


def test_exclusive_mark_skips_the_last_stamp(spark, path):
    land(spark, path("l"), "1", '{"id": 1, "gone": 1}')
    mark = bronze.update_from_json(spark, path("l"), path("b"))
    land(spark, path("l"), "2", '{"id": 2}')
    mark = bronze.update_from_json(spark, path("l"), path("b"), mark=mark, inclusive=False)
    assert mark == "2"
    again = bronze.update_from_json(spark, path("l"), path("b"), mark=mark, inclusive=False)
    table = files.read_stamped(spark, path("b"), "partition")
    assert again == "2" and rows(table.select("id", "gone")) == [("1", "1"), ("2", None)]


def test_empty_input_keeps_the_mark(spark, path):
    land(spark, path("l"), "20250101000000", '{"id": 1}')
    bronze.update_from_json(spark, path("l"), path("b"))
    assert bronze.update_from_json(spark, path("l"), path("b"), mark="20990101000000") == "20990101000000"
    assert files.read_table(spark, path("b")).count() == 1


def test_bronze_loads_an_unchanged_stamp_once(spark, path):
    def files_of(stamp):
        return {f.name for f in Path(path("b"), f"partition={stamp}").glob("*.parquet")}

    def run(mark, **options):
        return bronze.update_from_json(spark, path("l"), path("b"), mark=mark, **options)

    land(spark, path("l"), "20250101000000", '{"a": [1, 2]}')
    assert all(f.suffix == ".lz4" for f in Path(path("l")).rglob("part-*"))
    mark = run(None)
    first = files_of(mark)
    land(spark, path("l"), "20250201000000", '{"a": [3], "b": 1}')
    assert run(mark) == "20250201000000" and files_of("20250101000000") == first
    # Its own stamp again: nothing new.
    mark, second = "20250201000000", files_of("20250201000000")
    assert run(mark) == mark and files_of(mark) == second
    # A file more in it: it is loaded again, whole and once.
    land(spark, path("l"), mark, '{"a": [4, 5]}')
    assert run(mark) == mark and files_of(mark) != second
    table = files.read_table(spark, path("b"), evolved=True)
    assert sorted(r.a for r in table.collect()) == ["1", "2", "3", "4", "5"]
    # So it is if it is loaded in another way.
    second = files_of(mark)
    run(mark, multi_line=True)
    assert files_of(mark) != second
    assert files.read_table(spark, path("b"), evolved=True).count() == 5


def test_bronze_parquet(spark, path):
    df = spark.sql("select 1 as `a.b`, array(1, 2) as c, map('k', 1) as m")
    landing.land_rows(df, path("l"), stamp="20250101000000")
    assert bronze.update_from_parquet(spark, path("l"), path("b")) == "20250101000000"
    table = files.read_table(spark, path("b")).select("a_b", "c", "m")
    assert rows(table) == [("1", "[1,2]", '{"k":1}')]


# --- silver ---


def roles(**keys_):
    records = [
        {"expression": "k", "column_type": "int", "column_name": "k", "column_order": 1, "is_output": 1},
        {"expression": "v", "column_type": "string", "column_name": "v", "column_order": 2, "is_output": 1},
        {"expression": "p", "column_type": "string", "column_name": "p", "column_order": 3, "is_output": 1},
        {"expression": "partition", "column_type": "string", "column_name": "stamp",
         "column_order": 4, "is_order_by": 1},
    ]
    for record in records:
        record.update({role: n for role, columns in keys_.items()
                       for n, c in enumerate(columns, 1) if c == record["column_name"]})
    return SilverRoles.parse(records)


FIRST = [("1", "a", "x", "1"), ("2", "b", "x", "1"), ("3", "c", "y", "1"), ("4", "d", None, "1")]
SECOND = [("2", "B", "x", "2"), ("5", "e", "x", "2"), (None, "n", "x", "2")]


def run_silver(spark, path, method, role, second=SECOND, **options):
    schema = "k string, v string, p string, partition string"
    write = spark.createDataFrame(FIRST, schema).write.partitionBy("partition")
    write.parquet(path("b"))
    mark = silver.update_silver(spark, path("b"), path("s"), role, method, **options)
    spark.createDataFrame(second, schema).write.mode("append").partitionBy("partition").parquet(path("b"))
    mark = silver.update_silver(
        spark, path("b"), path("s"), role, method, mark=mark, inclusive=False, **options
    )
    assert mark == "2"
    return rows(files.read_table(spark, path("s")).select("k", "v", "p"))


OLD = [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", None)]


def test_pk_merge(spark, path):
    assert run_silver(spark, path, "pk_merge", roles(is_primary_key=["k"])) == sorted(
        [OLD[0], (2, "B", "x"), OLD[2], OLD[3], (5, "e", "x")], key=repr
    )


def test_pk_merge_rewrites_only_touched_partitions(spark, path):
    role = roles(is_primary_key=["k"], is_partition_by=["p"])
    got = run_silver(spark, path, "pk_merge", role, partitions_immutable=True)
    assert got == sorted([OLD[0], (2, "B", "x"), OLD[2], OLD[3], (5, "e", "x")], key=repr)
    untouched = list(Path(path("s"), "p=y").glob("*.parquet"))
    before = [f.stat().st_mtime_ns for f in untouched]
    silver.update_silver(spark, path("b"), path("s"), role, "pk_merge", mark=2, partitions_immutable=True)
    assert [f.stat().st_mtime_ns for f in untouched] == before


@pytest.mark.parametrize("immutable", [False, True])
def test_bk_merge(spark, path, immutable):
    role = roles(is_batch_key=["p"], is_partition_by=["p"])
    got = run_silver(spark, path, "bk_merge", role, partitions_immutable=immutable)
    assert got == sorted([(2, "B", "x"), (5, "e", "x"), (None, "n", "x"), OLD[2], OLD[3]], key=repr)


def test_append_and_overwrite(spark, path):
    assert len(run_silver(spark, path, "append", roles())) == 7
    # The mark still limits what an overwrite holds.
    silver.update_silver(spark, path("b"), path("s"), roles(), "overwrite", mark=2)
    assert files.read_table(spark, path("s")).count() == 3


def test_missing_mark_or_refresh_overwrites(spark, path):
    run_silver(spark, path, "append", roles())
    silver.update_silver(spark, path("b"), path("s"), roles(), "append", mark=2, full_refresh=True)
    assert files.read_table(spark, path("s")).count() == 7
    silver.update_silver(spark, path("b"), path("s"), roles(), "append")
    assert files.read_table(spark, path("s")).count() == 7


def test_outputs_are_required(spark):
    with pytest.raises(ValueError):
        silver.silver_transform(spark.range(1), SilverRoles(columns=()))


def test_write_methods_are_checked(spark, path):
    df = spark.createDataFrame([(1, "a", "x")], "k int, v string, p string")
    with pytest.raises(ValueError):
        silver.write_silver(df, path("s"), roles(), "merge")
    for method in ("pk_merge", "bk_merge"):
        with pytest.raises(ValueError):
            silver.write_silver(df, path("s"), roles(), method)
    assert silver.default_write_method(roles()) == "append"
    assert silver.default_write_method(roles(is_primary_key=["k"])) == "pk_merge"
    assert silver.default_write_method(roles(is_primary_key=["k"], is_batch_key=["p"])) == "bk_merge"


# --- gold ---

HISTORY = HistoryRoles(("id",), ("name",), "day", "vf", "vt", "cur", "hash", "sk")


def snapshot(spark, path, day, **states):
    df = spark.createDataFrame([(k, v, dt.date(2024, 1, day)) for k, v in states.items()],
                               "id string, name string, day date")
    df.write.mode("append").partitionBy("day").parquet(path("s"))


def history_rows(spark, path):
    found = files.read_table(spark, path("h")).select("id", "name", "vf", "vt", "cur", "sk").collect()
    return sorted((r.id, r.name, r.vf.day, None if r.cur else r.vt.day) for r in found), found


def test_history_table_runs_are_repeatable_and_touch_two_partitions(spark, path):
    snapshot(spark, path, 1, a="1", b="1", c="1")
    snapshot(spark, path, 2, a="2", b="1", c="1")
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY)
    assert mark == dt.date(2024, 1, 2)
    snapshot(spark, path, 3, a="2", b="2", d="1")
    expected = [("a", "1", 1, 2), ("a", "2", 2, None), ("b", "1", 1, 3), ("b", "2", 3, None),
                ("c", "1", 1, 3), ("d", "1", 3, None)]
    for run in range(2):
        mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
        got, found = history_rows(spark, path)
        assert got == expected and mark == dt.date(2024, 1, 3)
        assert len({r.sk for r in found}) == 6
        if run == 0:  # what was closed before the mark's day is not touched again
            closed = list(Path(path("h"), "vt=2024-01-02").rglob("*.parquet"))
            before = [f.stat().st_mtime_ns for f in closed]
    assert closed and [f.stat().st_mtime_ns for f in closed] == before
    # A corrected snapshot of the same day adds to the versions closed on that day.
    snapshot(spark, path, 3, e="1")
    corrected = files.read_table(spark, path("s")).filter("day = date'2024-01-03'")
    assert corrected.count() == 4
    gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
    assert history_rows(spark, path)[0] == sorted([*expected, ("e", "1", 3, None)])


def test_scratch_tables_go_when_the_result_is_stored(spark, path):
    def scratch():
        return set(Path(shared.shared_dir(spark), "lakeloom").glob("*"))

    snapshot(spark, path, 1, a="1")
    before = scratch()
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY)
    snapshot(spark, path, 2, a="2")
    gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark)
    assert scratch() == before
    with pytest.raises(RuntimeError), shared.scratch_tables(spark):
        shared.materialize(spark.range(1), "kept")
        raise RuntimeError
    assert len(scratch() - before) == 1


def test_history_without_news(spark, path):
    snapshot(spark, path, 1, a="1")
    mark = gold.update_history_table(spark, path("s"), path("h"), HISTORY)
    late = dt.date(2025, 1, 1)
    assert gold.update_history_table(spark, path("s"), path("h"), HISTORY, late) == late
    assert history_rows(spark, path)[0] == [("a", "1", 1, None)] and mark == dt.date(2024, 1, 1)
    gold.update_history_table(spark, path("s"), path("h"), HISTORY, mark, full_refresh=True)
    assert history_rows(spark, path)[0] == [("a", "1", 1, None)]


def test_dimension_table(spark, path):
    role = DimensionRoles(("k",), "sk", ("stamp",))
    schema = "k string, v string, stamp string"
    spark.createDataFrame([("b", "1", "1"), ("a", "1", "1")], schema).write.parquet(path("s"))
    assert gold.update_dimension_table(spark, path("s"), path("d"), role, "stamp") == "1"
    news = spark.createDataFrame([("b", "2", "2"), ("c", "2", "2"), (None, "2", "2")], schema)
    news.write.mode("append").parquet(path("s"))
    assert gold.update_dimension_table(spark, path("s"), path("d"), role, "stamp", "2") == "2"
    assert rows(files.read_table(spark, path("d")).select("k", "v", "sk")) == [
        ("a", "1", 1), ("b", "2", 2), ("c", "2", 3),
    ]


# --- plans that must hold at any size ---


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LINES = "/root/testdata/sf0.001/lineitem.parquet"
ORDERS = "/root/testdata/sf0.001/orders.parquet"


def test_latest_row_is_cut_before_the_shuffle(spark):
    text = plan(dedup.latest_per_key(spark.read.parquet(LINES), ["l_orderkey"], ["l_shipdate"]))
    before_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange


def test_marks_and_columns_reach_the_scan(spark):
    df = filters.since(spark.read.parquet(LINES), "l_orderkey", "77").select("l_tax")
    text = plan(df)
    assert "GreaterThanOrEqual(l_orderkey,77)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in text
    newest = plan(filters.latest_snapshot(spark.read.parquet(LINES), "l_shipdate"))
    assert "PushedFilters: [IsNotNull(l_shipdate), EqualTo(l_shipdate," in newest


def test_stamps_prune_partitions(spark, path):
    spark.range(10).withColumn("p", F.col("id").cast("string")).write.partitionBy("p").parquet(path("t"))
    df = files.read_table(spark, path("t"), "p", "7")
    assert "PartitionFilters: [isnotnull(p" in plan(df) and len(df.inputFiles()) == 10


def all_plans(spark):
    lines, orders = spark.read.parquet(LINES), spark.read.parquet(ORDERS)
    yield dedup.latest_per_batch(lines, ["l_suppkey"], ["l_returnflag", "l_linestatus"])
    yield dedup.last_batch(lines, ["l_suppkey"], ["l_returnflag"])
    yield merge.upsert(orders, orders, ["o_orderkey"], unique=True)
    yield merge.replace_batches(orders, orders, ["o_custkey"])
    yield filters.latest_snapshot(lines, "l_shipdate")
    days = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"),
                         F.to_date("o_orderdate").alias("day"))
    target = history.build_history(days, HISTORY)
    yield target
    yield history.update_history(days, target, HISTORY)


def test_no_cross_joins(spark):
    for df in all_plans(spark):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_numbering_uses_no_single_partition_for_rows(spark):
    text = plan(keys.number_rows(spark.read.parquet(ORDERS), ["o_orderkey"], "sk"))
    singles = [i for i in range(len(text)) if text.startswith("Exchange SinglePartition", i)]
    # The only one gathers a row per partition, after the count.
    assert len(singles) == 1 and "partial_count" in text[singles[0]:]


def test_hot_keys_are_split(spark):
    """A third of all rows share a key: adaptive execution splits it over several tasks."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    target = spark.range(300_000).select(hot.alias("k"), F.col("id").alias("v"))
    batches = spark.range(1, 300_000, 2).select(F.col("id").alias("k"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept = merge.delete_matching(target, batches, ["k"])
        assert kept.filter("k = 0").count() == 100_000
        kept.collect()
        assert "skew=true" in plan(kept)
        latest = dedup.latest_per_batch(target.withColumn("o", F.lit(1)), ["k"], ["o"])
        assert len(latest.collect()) == 300_000
        assert "skew=true" in plan(latest)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_merge_does_not_shuffle_the_target_by_its_partitions(spark, path):
    kinds = F.when(F.col("id") % 3 > 0, F.lit("x")).alias("p")
    spark.range(100).select("id", kinds).write.parquet(path("t"))
    updates = spark.range(3_000_000).select("id", F.lit("x").alias("p"), F.col("id").alias("v"))
    kept = merge.in_partitions(spark.read.parquet(path("t")), updates, ["p"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert kept.count() == 66
    others = merge.in_partitions(spark.read.parquet(path("t")), updates, ["p"], touched=False)
    assert others.count() == 34
