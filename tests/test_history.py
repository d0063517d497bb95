import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.operators import history, segments
from lakeloom.roles import DimensionRoles, HistoryRoles

ROLES = HistoryRoles(("id",), ("name", "note"), "day", "vf", "vt", "cur", "hash", "sk")
SOURCE = "id int, name string, note string, day date"
OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2024, 1, n)


def state(spark, *data):
    return spark.createDataFrame([(i, n, None, day(d)) for i, n, d in data], SOURCE)


def versions(df):
    """(id, name, first day, last day or None) with surrogate keys checked to be unique."""
    found = df.collect()
    assert len({r.sk for r in found}) == len(found)
    assert all(r.cur == (r.vt == OPEN) for r in found)
    return sorted((r.id, r.name, r.vf.day, None if r.cur else r.vt.day) for r in found)


def test_full_build(spark):
    df = state(spark, (1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "a", 5), (2, "x", 2))
    built = history.build_history(df, ROLES)
    assert versions(built) == [(1, "a", 1, 3), (1, "a", 5, None), (1, "b", 3, 5), (2, "x", 2, None)]
    assert [r.sk for r in built.orderBy("id", "vf").collect()] == [1, 2, 3, 4]
    assert versions(history.build_history(df, ROLES, unique=True)) == versions(built)


def test_full_build_can_close_missing_keys(spark):
    df = state(spark, (1, "a", 1), (2, "x", 1), (2, "x", 2), (1, "a", 3), (2, "x", 3), (2, "x", 4))
    assert versions(history.build_history(df, ROLES, close_missing=True)) == [
        (1, "a", 1, 2), (1, "a", 3, 4), (2, "x", 1, None),
    ]


def test_null_keys_and_dates_have_no_history(spark):
    df = spark.createDataFrame([(None, "a", None, day(1)), (1, "a", None, None)], SOURCE)
    assert history.build_history(df, ROLES).count() == 0


def test_null_values_are_a_change(spark):
    df = spark.createDataFrame(
        [(1, None, "a", day(1)), (1, "a", None, day(2)), (1, "", None, day(3))], SOURCE
    )
    assert history.build_history(df, ROLES).count() == 3


def test_increment_on_five_keys(spark):
    """1 unchanged, 2 changed, 3 deleted, 4 new, 5 returning."""
    before = state(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1), (5, "e", 1),
                   (1, "a", 2), (2, "b", 2), (3, "c", 2))
    target = history.build_history(before, ROLES, close_missing=True)
    assert (5, "e", 1, 2) in versions(target)
    source = before.union(state(spark, (1, "a", 3), (2, "B", 3), (4, "d", 3), (5, "e", 3)))
    result = history.update_history(source, target, ROLES)
    assert versions(result) == [
        (1, "a", 1, None), (2, "B", 3, None), (2, "b", 1, 3), (3, "c", 1, 3),
        (4, "d", 3, None), (5, "e", 1, 2), (5, "e", 3, None),
    ]
    added = sorted(r.sk for r in result.filter("vf = date'2024-01-03'").collect())
    assert added == [5, 6, 7]
    assert versions(history.update_history(source, result, ROLES)) == versions(result)
    assert result.columns == target.columns


def test_increment_after_nulls_sees_no_false_change(spark):
    df = spark.createDataFrame([(1, None, "a", day(1)), (1, None, "a", day(2))], SOURCE)
    target = history.build_history(df.filter("day = date'2024-01-01'"), ROLES)
    assert history.update_history(df, target, ROLES).count() == 1


def test_empty_increment_changes_nothing(spark):
    target = history.build_history(state(spark, (1, "a", 1)), ROLES)
    result = history.update_history(state(spark, (1, "a", 1)).limit(0), target, ROLES)
    assert versions(result) == [(1, "a", 1, None)]


def test_single_steps_add_up_to_the_increment(spark):
    before = state(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1))
    target = history.build_history(before, ROLES)
    updates = history.snapshot_updates(state(spark, (1, "a", 2), (2, "B", 2), (4, "d", 2)), ROLES)
    assert [r.id for r in history.changed_rows(updates, target, ROLES).collect()] == [2]
    assert [r.id for r in history.missing_keys(updates, target, ROLES).collect()] == [3]
    assert [r.id for r in history.new_versions(updates, target, ROLES).collect()] == [4]
    numbered = history.number_versions(updates, target, ROLES)
    step = history.insert_new(numbered, target, ROLES)
    changed = history.changed_rows(numbered, target, ROLES).select(*target.columns)
    step = history.expire_updated(updates, step.unionByName(changed).filter("vf < date'2024-01-02' or id = 4"), ROLES)
    step = history.expire_deleted(updates, step, ROLES).unionByName(changed)
    assert versions(step) == versions(history.apply_snapshot(updates, target, ROLES))


def test_change_groups(spark):
    df = state(spark, (1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "a", 4), (2, "a", 1))
    got = segments.change_groups(df, ["id"], "day", "name")
    assert [r.group_id for r in got.orderBy("id", "day").collect()] == [0, 0, 1, 2, 0]


snapshots = st.lists(
    st.dictionaries(st.integers(1, 4), st.sampled_from(["a", "b"]), min_size=1), min_size=2, max_size=5
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshots)
def test_folded_increments_equal_the_full_build(spark, data):
    all_states = state(spark, *[(k, v, n) for n, s in enumerate(data, 1) for k, v in s.items()])
    full = history.build_history(all_states, ROLES, close_missing=True)
    first = all_states.filter(F.col("day") == day(1))
    folded = start = history.build_history(first, ROLES)
    for n in range(2, len(data) + 1):
        folded = history.update_history(all_states.filter(F.col("day") <= day(n)), folded, ROLES)
    assert versions(folded) == versions(full)
    assert versions(history.extend_history(all_states, start, ROLES, day(1))) == versions(full)
    current = full.filter("cur").groupBy("id").count().filter("count > 1")
    assert current.count() == 0
    spans = {}
    for id_, _, begin, end in versions(full):
        spans.setdefault(id_, []).append((begin, end or 99))
    for found in map(sorted, spans.values()):
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


# --- type 1 ---

DIM = DimensionRoles(("k",), "sk", ("o",))


def test_dimension_rebuild(spark):
    df = spark.createDataFrame([(2, 1, "x"), (1, 1, "y"), (1, 2, "z"), (None, 9, "n")], "k int, o int, v string")
    assert sorted(map(tuple, history.rebuild_dimension(df, DIM).collect())) == [
        (1, 2, "z", 1), (2, 1, "x", 2),
    ]


def test_unordered_duplicates_are_refused(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError):
        history.rebuild_dimension(df, DimensionRoles(("k",), "sk"))


def test_dimension_update(spark):
    target = spark.createDataFrame(
        [(1, 1, "a", 10, "keep"), (2, 1, "b", 20, "keep")], "k int, o int, v string, sk int, extra string"
    )
    source = spark.createDataFrame(
        [(2, 2, None), (2, 1, "old"), (4, 1, "d"), (3, 1, "c"), (None, 1, "n")], "k int, o int, v string"
    )
    result = history.update_dimension(source, target, DIM)
    assert result.dtypes == target.dtypes
    assert sorted(map(tuple, result.collect())) == [
        (1, 1, "a", 10, "keep"), (2, 2, None, 20, "keep"), (3, 1, "c", 21, None), (4, 1, "d", 22, None),
    ]
    with pytest.raises(ValueError):
        history.update_dimension(source.withColumn("zz", F.lit(1)), target, DIM)
