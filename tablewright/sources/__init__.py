"""Readers, writers, SQL views and the stand-in tables built from the
driver's parquet tables."""

from tablewright.sources.files import (
    load_table,
    read_lines,
    read_csv,
    read_csv_doubles,
    write_lines,
    write_csv,
    write_table,
    register_view,
    run_sql,
)

__all__ = ["load_table", "read_lines", "read_csv", "read_csv_doubles",
           "write_lines", "write_csv", "write_table", "register_view", "run_sql"]
