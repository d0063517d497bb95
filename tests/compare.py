"""Compare a Spark result with SQL over the same parquet files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when rows, columns and values agree."""
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = bag(expected_columns, cursor.fetchall())
    actual = bag(df.columns, df.collect())
    found = []
    if sorted(df.columns) != sorted(expected_columns):
        found.append(f"columns {sorted(df.columns)} are not {sorted(expected_columns)}")
    if actual != expected:
        extra, lacking = actual - expected, expected - actual
        found.append(
            f"{actual.total()} rows, {expected.total()} expected; {extra.total()} extra "
            f"{list(extra)[:2]}, {lacking.total()} lacking {list(lacking)[:2]}"
        )
    return found
