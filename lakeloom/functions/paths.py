"""Logical dataset paths ``type:workspace/store/...`` kept in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.constants import (
    API_FILES_ROOT,
    FILES_ROOT,
    FILES_TYPE,
    NOT_IMPLEMENTED_TYPES,
    STORE_SUFFIX,
    TABLE_TYPE,
    TABLES_ROOT,
    WAREHOUSE_TYPE,
)


def split_paths(df: DataFrame, path: str) -> DataFrame:
    """Add the parts of a logical path; a type that has no layout gets an error status."""
    text = F.col(path)
    kind = F.lower(F.substring_index(text, ":", 1))
    pieces = F.split(F.expr(f"substring(`{path}`, locate(':', `{path}`) + 1)"), "/")
    is_files, is_table, is_warehouse = (
        kind == t for t in (FILES_TYPE, TABLE_TYPE, WAREHOUSE_TYPE)
    )

    def piece(position: int) -> Column:
        return F.get(pieces, F.lit(position))

    known = is_files | is_table | is_warehouse
    enough = F.size(pieces) >= F.when(is_table, 5).otherwise(4)
    directory = F.array_join(F.slice(pieces, 4, F.greatest(F.size(pieces) - 3, F.lit(0))), "/")
    parts = {
        "path_type": kind,
        "workspace": F.when(known, piece(0)),
        "store": F.when(known, piece(1)),
        "area": F.when(is_files | is_table, piece(2)),
        "schema_name": F.when(is_table, piece(3)).when(is_warehouse, piece(2)),
        "table_name": F.when(is_table, piece(4)).when(is_warehouse, piece(3)),
        "directory": F.when(is_files, directory),
        "path_status": F.when(~text.contains(":"), "malformed")
        .when(kind.isin(*NOT_IMPLEMENTED_TYPES), "not implemented")
        .when(~known, "unrecognized")
        .when(~enough, "malformed")
        .otherwise("ok"),
    }
    return df.select("*", *[column.alias(name) for name, column in parts.items()])


def physical_path(form: str, host: str = "") -> Column:
    """The stored location, from the columns of ``split_paths``; NULL where a path type has
    no such form.  ``host`` is the storage endpoint of the ``abfss`` form."""
    ok = F.col("path_status") == "ok"
    files, table = (ok & (F.col("path_type") == t) for t in (FILES_TYPE, TABLE_TYPE))
    in_files = F.col("directory")
    in_tables = F.concat_ws("/", "schema_name", "table_name")
    match form.lower():
        case "api":
            return F.when(files, F.concat(F.lit(API_FILES_ROOT), in_files)).when(
                table, F.concat_ws(".", "store", "schema_name", "table_name")
            )
        case "catalog":
            return F.when(table, F.concat_ws(".", "store", "table_name"))
        case "relative":
            return F.when(files, F.concat(F.lit(FILES_ROOT), in_files)).when(
                table, F.concat(F.lit(TABLES_ROOT), in_tables)
            )
        case "abfss":
            root = F.concat(
                F.lit("abfss://"), "workspace", F.lit(f"@{host}/"), "store", F.lit(STORE_SUFFIX)
            )
            return F.when(files, F.concat(root, F.lit(FILES_ROOT), in_files)).when(
                table, F.concat(root, F.lit(TABLES_ROOT), in_tables)
            )
    raise ValueError(f"Unrecognized path form {form!r}.")
