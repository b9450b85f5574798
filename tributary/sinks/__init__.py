"""Sinks: the raw JSON layer and typed catalog tables."""

from tributary.sinks.raw import (
    raw_path,
    read_raw,
    read_raw_positional,
    stringify,
    write_raw,
    write_raw_positional,
    write_raw_responses,
)
from tributary.sinks.table import (
    APPENDED,
    CREATED,
    REPLACED,
    SKIPPED,
    SchemaMismatchError,
    TableLoad,
    TableOwnerError,
    same_columns,
    table_owner,
    write_table,
)

__all__ = [
    "APPENDED",
    "CREATED",
    "REPLACED",
    "SKIPPED",
    "SchemaMismatchError",
    "TableLoad",
    "TableOwnerError",
    "raw_path",
    "read_raw",
    "read_raw_positional",
    "same_columns",
    "stringify",
    "table_owner",
    "write_raw",
    "write_raw_positional",
    "write_raw_responses",
    "write_table",
]
