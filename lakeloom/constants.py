"""Results match only while these stay as they are."""

# --- fixed values ---------------------------------------------------------------

# History tables: open end of a version, and the change hash.
OPEN_END = "9999-12-31"
HASH_SEPARATOR = "||"
HASH_NULL = "∅"
HASH_BITS = 256

# Characters that clean column names lose; dots become underscores first.
UNCLEAN_NAME_CHARACTERS = r"[^0-9A-Za-z_]"

# Logical path types with a layout, types known without one, and the roots of stored paths.
FILES_TYPE = "lakefiles"
TABLE_TYPE = "deltalake"
WAREHOUSE_TYPE = "warehouse"
NOT_IMPLEMENTED_TYPES = ("database", "eventhouse")
API_FILES_ROOT = "/lakehouse/default/Files/"
FILES_ROOT = "Files/"
TABLES_ROOT = "Tables/"
STORE_SUFFIX = ".Lakehouse/"

# Extraction stamp of landed files and the date-time text understood by the shorthands.
STAMP_FORMAT = "yyyyMMddHHmmss"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LOCAL_ZONE = "America/New_York"

# Write methods of a silver update.
WRITE_METHODS = ("overwrite", "append", "pk_merge", "bk_merge")

# Service responses: the error number of an expired session, and the texts reported.
EXPIRED_SESSION = "XL03000006"
BAD_STATUS_CODE_TEXT = "Status code is not 200."
EXPIRED_TEXT = "Session expired."
ERROR_TEXT = "Response has an error."
NO_STATUS_TEXT = "Response missing status."
FAILED_TEXT = "Response failed status."
BAD_XML_TEXT = "Response xml is unexpected."

# The table of jobs.
JOBS_SCHEMA = "job_id int, job_name string, task_sql string"

# Kinds of tasks, which are also the names of their tables, and the columns of their marks.
JSON_TASK = "task_json_to_delta"
PARQUET_TASK = "task_parquet_to_delta"
SILVER_TASK = "task_update_silver"
HISTORY_TASK = "task_create_scd2"
IDENTITY_TASK = "task_identity_transfer"
MARKS = {
    "task_json_to_delta": "min_partition",
    "task_parquet_to_delta": "min_partition",
    "task_update_silver": "min_partition",
    "task_create_scd2": "min_date_key",
}

# The task tables that say which dataset a task writes.
TARGET_TABLES = (
    "task_pokemon_api",
    "task_json_to_delta",
    "task_parquet_to_delta",
    "task_update_silver",
    "task_create_scd2",
    "task_identity_transfer",
    "task_to_warehouse",
)
