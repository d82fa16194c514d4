"""Reading and writing: CSV, Parquet, JDBC tables and working storage."""

from prepmill.sources.files import (
    read_csv_inferred,
    read_csv_strict,
    read_parquet,
    write_csv,
    write_parquet,
)
from prepmill.sources.jdbc import JdbcTable, balanced_predicates, read_table, write_table
from prepmill.sources.storage import materialize, scratch_path, stored_bytes, working_storage

__all__ = [
    "JdbcTable",
    "balanced_predicates",
    "materialize",
    "read_csv_inferred",
    "read_csv_strict",
    "read_parquet",
    "read_table",
    "scratch_path",
    "stored_bytes",
    "working_storage",
    "write_csv",
    "write_parquet",
    "write_table",
]
