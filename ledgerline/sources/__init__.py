"""Readers, role views and sinks."""

from ledgerline.sources.files import load_tables, read_csv_inferred, read_csv_strict
from ledgerline.sources.schemas import SCHEMAS
from ledgerline.sources.sinks import (
    append_table, create_table_if_absent, replace_table, update_where, write_if_absent,
)

__all__ = [
    "SCHEMAS", "read_csv_strict", "read_csv_inferred", "load_tables",
    "create_table_if_absent", "append_table", "write_if_absent", "replace_table",
    "update_where",
]
