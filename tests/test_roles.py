import json

import pytest
from pyspark.sql import Row

from lakeloom.roles import DimensionRoles, HistoryRoles, SilverRoles


def record(name, **roles):
    return {"column_name": name, **roles}


def silver(name, order, **roles):
    return record(name, expression=name, column_type="string", column_order=order, **roles)


def test_silver_roles_follow_ordinals_and_flags():
    roles = SilverRoles.parse(
        json.dumps(
            [
                silver("b", 2, is_order_by=1, is_output=1, is_partition_by=2),
                silver("a", 1, is_primary_key=1, is_order_by=2, is_output=1, is_partition_by=1),
                silver("f", 3, is_filter=1, is_batch_key=True),
            ]
        )
    )
    assert [c.name for c in roles.columns] == ["a", "b", "f"]
    assert roles.order_by == ("b", "a") and roles.partition_by == ("a", "b")
    assert roles.primary_keys == ("a",) and roles.batch_keys == ("f",) == roles.filters
    assert roles.outputs == ("b", "a")


def test_roles_come_from_rows_too():
    rows = [Row(column_name="k", is_business_key=1, is_order_by=0, is_surrogate_key=0),
            Row(column_name="sk", is_business_key=0, is_order_by=0, is_surrogate_key=1)]
    assert DimensionRoles.parse(rows) == DimensionRoles(("k",), "sk", ())


@pytest.mark.parametrize("records", [
    [record("sk", is_surrogate_key=1)],
    [record("k", is_business_key=1)],
    [record("k", is_business_key=1), record("a", is_surrogate_key=1),
     record("b", is_surrogate_key=1)],
])
def test_dimension_roles_are_checked(records):
    with pytest.raises(ValueError):
        DimensionRoles.parse(records)


HISTORY = {
    "Id": "is_primary_key", "Name": "is_business_key", "Day": "is_date_key",
    "From": "is_valid_from", "To": "is_valid_to", "On": "is_is_current",
    "Hash": "is_row_hash", "Sk": "is_surrogate_key",
}


def test_history_roles():
    roles = HistoryRoles.parse([record(n, **{r: 1}) for n, r in HISTORY.items()])
    assert roles.primary_keys == ("Id",) and roles.tracked == ("Name",)
    assert roles.generated == ("Hash", "From", "To", "On", "Sk")


@pytest.mark.parametrize("missing", list(HISTORY))
def test_each_history_role_is_required(missing):
    with pytest.raises(ValueError):
        HistoryRoles.parse([record(n, **{r: 1}) for n, r in HISTORY.items() if n != missing])


@pytest.mark.parametrize("twice", ["is_date_key", "is_surrogate_key"])
def test_single_history_roles_are_single(twice):
    records = [record(n, **{r: 1}) for n, r in HISTORY.items()]
    with pytest.raises(ValueError):
        HistoryRoles.parse([*records, record("Other", **{twice: 1})])
