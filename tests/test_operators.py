import random
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.operators import aggregates, dedup, filters, keys, lineage, marks, merge, metadata
from lakeloom.constants import JOBS_SCHEMA

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- filters and marks ---


def test_since_is_inclusive_and_optional(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "p bigint")
    assert rows(filters.since(df, "p", "2")) == [(2,), (3,)]
    for mark in (None, ""):
        assert filters.since(df, "p", mark).count() == 3
    assert filters.since(df, None, 2).count() == 3


def test_flags(spark):
    df = spark.createDataFrame(
        [(1, True, True), (2, True, None), (3, False, True)], "id int, a boolean, b boolean"
    )
    assert rows(filters.keep_flagged(df, ["a", "b"]).select("id")) == [(1,)]
    assert filters.keep_flagged(df, []).count() == 3
    assert tuple(filters.filter_metrics(df, ["a", "b"]).first()) == (3, 1, 2)
    with pytest.raises(ValueError):
        filters.keep_flagged(df, ["zz"])
    with pytest.raises(TypeError):
        filters.keep_flagged(df, ["id"])


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (1, None)], "a int, b int")
    assert rows(filters.drop_null_keys(df, ["a", "b"])) == [(1, 1)]
    assert filters.drop_null_keys(df, []).count() == 3


def test_latest_snapshot_of_nothing(spark):
    assert filters.latest_snapshot(spark.createDataFrame([], "d date"), "d").count() == 0


def test_marks(spark):
    empty = spark.createDataFrame([], "p string")
    assert marks.read_mark(empty, "p") is None and marks.read_mark(empty, None) is None
    held = spark.createDataFrame([("a", "1"), ("b", "2")], "task_id string, m string")
    new = spark.createDataFrame([("b", "3"), ("a", None), ("c", "4"), ("d", None)], held.schema)
    assert rows(marks.upsert_marks(held, new, "m")) == [
        ("a", "1"), ("b", "3"), ("c", "4"), ("d", None),
    ]


# --- dedup ---


def test_nulls_order_last(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (2, None, "z")], "k int, o int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], ["o"])) == [(1, 5, "y"), (2, None, "z")]
    assert rows(dedup.latest_per_batch(df, ["k"], ["o"])) == [(1, 5, "y"), (2, None, "z")]
    assert rows(dedup.last_batch(df, ["k"], ["o"])) == [(1, 5, "y")]


def test_batches_keep_ties_null_keys_and_lexicographic_order(spark):
    df = spark.createDataFrame(
        [(1, 2, None, "a"), (1, 2, None, "b"), (1, 1, 9, "c"), (None, 1, 1, "d"), (None, 1, 0, "e")],
        "k int, o int, p int, v string",
    )
    assert rows(dedup.latest_per_batch(df, ["k"], ["o", "p"]).select("v")) == [
        ("a",), ("b",), ("d",),
    ]
    # Independent maxima: (2, 9) is no row of batch 1, and NULL batches never match.
    assert dedup.last_batch(df, ["k"], ["o", "p"]).count() == 0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(dedup.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]
    with pytest.raises(ValueError):
        dedup.require_unique(df, ["k"])
    dedup.require_unique(df.filter("k = 2 or k is null"), ["k"])
    assert dedup.any_per_key(df, ["k"]).count() == 3
    assert dedup.any_per_key(df, ["k", "v"]).count() == 3


def test_grouped_sum(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int")
    assert rows(aggregates.grouped_sum(df, ["k"], "v", "s")) == [("a", 3), ("b", None)]


@few
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 3) | st.none(),
                          st.integers(0, 9)), max_size=25))
def test_dedup_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int")

    def order(row):
        return (row[1] is not None, row[1] or 0)

    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    best = [max(g, key=lambda r: (order(r), r[2])) for g in groups.values()]
    ties = [r for g in groups.values() for r in g if order(r) == max(map(order, g))]
    assert rows(dedup.latest_per_key(df, ["k"], ["o"])) == sorted(best, key=repr)
    assert rows(dedup.latest_per_batch(df, ["k"], ["o"])) == sorted(ties, key=repr)


# --- keys ---


def test_numbering_is_dense_and_ordered(spark):
    df = spark.range(5000).select(F.pmod(F.hash("id"), F.lit(1000)).alias("a"), F.col("id").alias("b"))
    df = df.repartition(16).unionByName(spark.createDataFrame([(None, 1)], "a int, b bigint"))
    numbered = keys.number_rows(df, ["a", "b"], "sk", start=10)
    got = [(r.a, r.b) for r in numbered.orderBy("sk").collect()]
    assert [r.sk for r in numbered.orderBy("sk").collect()] == list(range(11, 5012))
    assert got[-1] == (None, 1) and got[:-1] == sorted(got[:-1])


def test_max_surrogate_of_nothing(spark):
    assert keys.max_surrogate(spark.createDataFrame([], "sk int"), "sk").first()[0] == 0
    assert keys.number_rows(spark.createDataFrame([], "a int"), ["a"], "sk").count() == 0


# --- merges ---


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "x", 1), (2, "x", 2), (None, "n", 3)], "k int, p string, v int")


def test_upsert(spark, target):
    updates = spark.createDataFrame([(5, 2, "x"), (6, 4, "y"), (7, None, "x")], "v long, k int, p string")
    assert rows(merge.upsert(target, updates, ["k"])) == [
        (1, "x", 1), (2, "x", 5), (4, "y", 6), (None, "n", 3),
    ]
    assert merge.upsert(target, updates, ["k"]).dtypes == target.dtypes


def test_upsert_refuses_duplicates_and_other_columns(spark, target):
    with pytest.raises(ValueError):
        merge.upsert(target, target.filter("k = 1").union(target.filter("k = 1")), ["k"])
    with pytest.raises(ValueError):
        merge.upsert(target, target.drop("v"), ["k"])


def test_replace_batches(spark, target):
    updates = spark.createDataFrame([(8, "x", 8), (9, "x", 9), (9, None, 9)], target.schema)
    assert rows(merge.replace_batches(target, updates, ["p"])) == [
        (8, "x", 8), (9, "x", 9), (None, "n", 3),
    ]


def test_partitions_of_updates_and_nulls(spark, target):
    updates = spark.createDataFrame([(1, None, 9), (2, "it's", 9)], target.schema)
    held = spark.createDataFrame([(1, None, 0), (2, "it's", 0), (3, "x", 0)], target.schema)
    assert rows(merge.in_partitions(held, updates, ["p"]).select("k")) == [(1,), (2,)]
    assert rows(merge.in_partitions(held, updates, ["p"], touched=False).select("k")) == [(3,)]
    assert merge.in_partitions(held, updates.limit(0), ["p"]).isEmpty()
    with pytest.raises(ValueError):
        merge.in_partitions(held, updates, [])


def test_more_partitions_than_any_guard(spark):
    held = spark.range(3000).selectExpr("id AS k", "id AS p", "'old' AS v")
    updates = spark.range(1500, 4000).selectExpr("id AS k", "id AS p", "'new' AS v")
    merged = merge.merge_in_partitions(held, updates, ["p"], lambda t, u: merge.upsert(t, u, ["k"]))
    assert rows(merged.groupBy("v").count()) == [("new", 2500), ("old", 1500)]


def test_rows_of_other_partitions_are_out_of_scope(spark, target):
    updates = spark.createDataFrame([(1, "y", 9)], target.schema)
    merged = merge.merge_in_partitions(
        target, updates, ["p"], lambda t, u: merge.upsert(t, u, ["k"])
    )
    assert rows(merged) == [(1, "x", 1), (1, "y", 9), (2, "x", 2), (None, "n", 3)]
    same = merge.merge_in_partitions(
        target, updates.limit(0), ["p"], lambda t, u: merge.upsert(t, u, ["k"])
    )
    assert rows(same) == rows(target)


@few
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 9)),
       st.dictionaries(st.integers(0, 9), st.integers(0, 9)))
def test_merges_are_idempotent(spark, held, new):
    schema = "k int, v int"
    t, u = (spark.createDataFrame(list(d.items()), schema) for d in (held, new))
    once = merge.upsert(t, u, ["k"])
    assert rows(once) == sorted(({**held, **new}).items(), key=repr)
    assert rows(merge.upsert(once, u, ["k"])) == rows(once)
    batches = merge.replace_batches(t, u, ["v"])
    assert rows(merge.replace_batches(batches, u, ["v"])) == rows(batches)


# --- metadata ---


def test_lookups(spark):
    table = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "task_id string, n int")
    assert rows(metadata.lookup_one(table, "a")) == [("a", 1)]
    assert metadata.lookup_all(table, "a").count() == 2
    both = spark.createDataFrame([("a",), ("b",), ("a",)], "task_id string")
    assert rows(metadata.lookup_one(table, both)) == [("a", 1), ("b", 3)]
    assert metadata.lookup_all(table, both).count() == 3
    assert metadata.lookup_one(table, "zz").count() == 0


def test_params(spark):
    static = spark.createDataFrame([("a", "x"), ("b", "y")], "task_id string, mode string")
    dynamic = spark.createDataFrame([("a", "1")], "task_id string, mark string")
    assert rows(metadata.resolve_params(static, dynamic)) == [("a", "x", "1"), ("b", "y", None)]
    given_ = metadata.resolve_params(static, dynamic, {"mark": "7", "mode": None})
    assert rows(given_) == [("a", "x", "7"), ("b", "y", "7")]
    with pytest.raises(ValueError):
        metadata.resolve_params(static, dynamic, {"zz": 1})


def test_job_tasks(spark):
    jobs = spark.createDataFrame(
        [(1, "raw", "select task_id from control_tasks where stage_name = 'raw'")],
        JOBS_SCHEMA,
    )
    tasks = spark.createDataFrame([("a", "raw"), ("b", "raw"), ("c", "x")], "task_id string, stage_name string")
    assert rows(metadata.job_tasks(jobs, 1, {"control_tasks": tasks})) == [("a",), ("b",)]
    assert "control_tasks" not in {t.name for t in spark.catalog.listTables()}


def test_unknown_job(spark):
    jobs = spark.createDataFrame([], JOBS_SCHEMA)
    with pytest.raises(ValueError):
        metadata.job_tasks(jobs, 1, {})


# --- lineage ---


def levels(spark, tasks, parents):
    """tasks: ids, each writing the dataset of its own name; parents: (dataset, parent)."""
    ids = spark.createDataFrame([(t,) for t in tasks], "task_id string")
    targets = ids.withColumn("dataset_path", F.col("task_id"))
    edges = lineage.lineage_edges(
        ids, targets, spark.createDataFrame(parents, "dataset_path string, parent_path string")
    )
    return {r.task_id: r for r in lineage.lineage_levels(edges).collect()}


def test_chain_diamond_and_orphan(spark):
    got = levels(
        spark,
        ["t:a", "t:b", "t:c", "t:d", "t:e", "plain"],
        [("t:a", None), ("t:b", "t:a"), ("t:c", "t:a"), ("t:c", "t:b"), ("t:d", "t:b"),
         ("t:d", "t:c"), ("t:e", "elsewhere")],
    )
    assert {k: r.batch_num for k, r in got.items()} == {
        "t:a": 1, "t:b": 2, "t:c": 3, "t:d": 4, "t:e": 1, "plain": 1,
    }
    assert got["plain"].task_status == "no prefix" and got["t:a"].pipeline_id == "t"


def test_unreachable_cycle_is_reported(spark):
    got = levels(spark, ["t:a", "t:b", "t:c"], [("t:b", "t:c"), ("t:c", "t:b")])
    assert got["t:b"].batch_num is None and got["t:b"].task_status == "cycle"
    assert got["t:a"].batch_num == 1


def test_cycle_behind_a_root_is_reported(spark):
    got = levels(spark, ["t:a", "t:b", "t:c", "t:d"],
                 [("t:b", "t:a"), ("t:b", "t:c"), ("t:c", "t:b"), ("t:d", "t:c")])
    assert {k: (r.batch_num, r.task_status) for k, r in got.items()} == {
        "t:a": (1, "ok"), "t:b": (None, "cycle"), "t:c": (None, "cycle"), "t:d": (None, "cycle"),
    }


def test_chain_of_many_levels(spark):
    n = 24
    got = levels(spark, [f"t:{k:03}" for k in range(n)],
                 [(f"t:{k:03}", f"t:{k - 1:03}") for k in range(1, n)])
    assert [r.batch_num for _, r in sorted(got.items())] == list(range(1, n + 1))


def test_one_parameter_set_per_task(spark):
    static = spark.createDataFrame([("a", "x"), ("b", "y")], "task_id string, path string")
    dynamic = spark.createDataFrame([("a", "2"), ("a", "1")], "task_id string, min_partition string")
    assert rows(metadata.resolve_params(static, dynamic)) == [("a", "x", "1"), ("b", "y", None)]


def test_views_of_the_caller_stay(spark):
    spark.range(7).createOrReplaceTempView("control_tasks")
    jobs = spark.createDataFrame([(1, "j", "select task_id from control_tasks where ok")],
                                 "job_id int, job_name string, task_sql string")
    tasks = spark.createDataFrame([("t:a", True), ("t:b", False)], "task_id string, ok boolean")
    assert rows(metadata.job_tasks(jobs, 1, {"control_tasks": tasks})) == [("t:a",)]
    assert spark.table("control_tasks").count() == 7


def test_level_tasks(spark):
    table = spark.createDataFrame([("t:a", "t", 1, "ok"), ("t:b", "t", 2, "ok")],
                                  "task_id string, pipeline_id string, batch_num int, task_status string")
    assert rows(lineage.level_tasks(table, 2)) == [("t:b", "t", 2)]


def test_levels_are_longest_chains_of_parents(spark):
    """Random graphs of chains, branches, rings and missing parents, against plain Python."""
    rng = random.Random(3)
    for _ in range(4):
        tasks = [f"t:{i}" for i in range(40)]
        parents = {(t, tasks[rng.randrange(max(1, i))]) for i, t in enumerate(tasks) for _ in range(rng.choice([0, 1, 1, 1, 2, 3])) if i}
        parents |= {("t:38", "t:39"), ("t:39", "t:38"), ("t:5", "absent")} if rng.random() < 0.7 else set()
        known = {}

        def level(task, above=()):
            if task in above:
                return None
            if task not in known:
                ups = [level(p, (*above, task)) for c, p in parents if c == task and p in tasks]
                known[task] = None if None in ups else 1 + max(ups, default=0)
            return known[task]

        expected = {t: level(t) for t in reversed(tasks)}
        got = levels(spark, tasks, [*parents])
        assert {t: r.batch_num for t, r in got.items()} == expected


def test_a_chain_of_a_thousand_is_few_jobs(spark):
    chain = spark.range(1000).select(
        F.concat(F.lit("t:"), F.col("id")).alias("task_id"),
        F.when(F.col("id") > 0, F.concat(F.lit("t:"), F.col("id") - 1)).alias("parent_id"),
    )
    tracker, group = spark.sparkContext.statusTracker(), "chain"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = lineage.lineage_levels(chain)
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found.agg(F.max("batch_num"), F.countDistinct("batch_num")).first() == (1000, 1000)
    assert jobs < 60  # those that only broadcast a small side included
