"""Column-role metadata: which column is a key, a filter, an order, an output and so on.

Records come as JSON text, as a list of dicts, or as collected metadata rows (tens of
records).  They are parsed and checked here, before any Spark plan is built.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

RoleRecords = str | Iterable[Mapping[str, Any]]


def is_true(value: bool | str | None) -> bool:
    """A yes-or-no parameter; metadata tables hold them as text."""
    return str(value).strip().lower() == "true"


def parse_records(records: RoleRecords) -> list[dict[str, Any]]:
    if isinstance(records, str):
        records = json.loads(records)
    return [r.asDict() if hasattr(r, "asDict") else dict(r) for r in records]


def _flagged(records: list[dict[str, Any]], role: str) -> tuple[str, ...]:
    return tuple(r["column_name"] for r in records if int(r.get(role) or 0) == 1)


def _by_ordinal(records: list[dict[str, Any]], role: str) -> tuple[str, ...]:
    ranked = [(int(r.get(role) or 0), r["column_name"]) for r in records]
    return tuple(name for ordinal, name in sorted(ranked, key=lambda p: p[0]) if ordinal > 0)


def _exactly_one(records: list[dict[str, Any]], role: str) -> str:
    names = _flagged(records, role)
    if len(names) != 1:
        raise ValueError(f"Exactly one column must have {role}; found {list(names)}.")
    return names[0]


def _at_least_one(records: list[dict[str, Any]], role: str) -> tuple[str, ...]:
    names = _flagged(records, role)
    if not names:
        raise ValueError(f"At least one column must have {role}.")
    return names


@dataclass(frozen=True)
class TypedColumn:
    """``expression`` is a column name, ``@`` + SQL, or a ``#shorthand(column)``."""

    expression: str
    type: str
    name: str


@dataclass(frozen=True)
class SilverRoles:
    columns: tuple[TypedColumn, ...]
    filters: tuple[str, ...] = ()
    primary_keys: tuple[str, ...] = ()
    batch_keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @classmethod
    def parse(cls, records: RoleRecords) -> SilverRoles:
        rows = parse_records(records)
        return cls(
            columns=tuple(
                TypedColumn(r["expression"], r["column_type"], r["column_name"])
                for r in sorted(rows, key=lambda r: r["column_order"])
            ),
            filters=_flagged(rows, "is_filter"),
            primary_keys=_flagged(rows, "is_primary_key"),
            batch_keys=_flagged(rows, "is_batch_key"),
            order_by=_by_ordinal(rows, "is_order_by"),
            outputs=_flagged(rows, "is_output"),
            partition_by=_by_ordinal(rows, "is_partition_by"),
        )


@dataclass(frozen=True)
class DimensionRoles:
    """Type-1 dimension: one row per business key, attributes overwritten."""

    business_keys: tuple[str, ...]
    surrogate_key: str
    order_by: tuple[str, ...] = ()

    @classmethod
    def parse(cls, records: RoleRecords) -> DimensionRoles:
        rows = parse_records(records)
        return cls(
            business_keys=_at_least_one(rows, "is_business_key"),
            surrogate_key=_exactly_one(rows, "is_surrogate_key"),
            order_by=_by_ordinal(rows, "is_order_by"),
        )


@dataclass(frozen=True)
class HistoryRoles:
    """Type-2 dimension: one row per version of a primary key.

    ``tracked`` are the columns whose change opens a new version.
    """

    primary_keys: tuple[str, ...]
    tracked: tuple[str, ...]
    date_key: str
    valid_from: str
    valid_to: str
    is_current: str
    row_hash: str
    surrogate_key: str

    @property
    def generated(self) -> tuple[str, ...]:
        return (self.row_hash, self.valid_from, self.valid_to, self.is_current, self.surrogate_key)

    @classmethod
    def parse(cls, records: RoleRecords) -> HistoryRoles:
        rows = parse_records(records)
        return cls(
            primary_keys=_at_least_one(rows, "is_primary_key"),
            tracked=_at_least_one(rows, "is_business_key"),
            date_key=_exactly_one(rows, "is_date_key"),
            valid_from=_exactly_one(rows, "is_valid_from"),
            valid_to=_exactly_one(rows, "is_valid_to"),
            is_current=_exactly_one(rows, "is_is_current"),
            row_hash=_exactly_one(rows, "is_row_hash"),
            surrogate_key=_exactly_one(rows, "is_surrogate_key"),
        )
