"""Shaping operators between fetch and sink."""

from tributary.operators.normalize import normalize, normalize_by_source
from tributary.operators.payload import (
    PLACEHOLDER_KEY,
    PLACEHOLDER_VALUE,
    VALUE_KEY,
    classify_responses,
    clean_record,
    explode_records,
    response_outcomes,
    response_records,
    skip_empty,
)
from tributary.operators.rows import GENERIC_PREFIX, generic_columns, named_rows, positional
from tributary.operators.schema import (
    FIRST_RECORD,
    UNION,
    SchemaConflictError,
    ddl,
    project_records,
    record_schema,
    storage_type,
    type_variant_columns,
)

__all__ = [
    "FIRST_RECORD",
    "GENERIC_PREFIX",
    "PLACEHOLDER_KEY",
    "PLACEHOLDER_VALUE",
    "UNION",
    "VALUE_KEY",
    "SchemaConflictError",
    "classify_responses",
    "clean_record",
    "ddl",
    "explode_records",
    "generic_columns",
    "named_rows",
    "normalize",
    "normalize_by_source",
    "positional",
    "project_records",
    "record_schema",
    "response_outcomes",
    "response_records",
    "skip_empty",
    "storage_type",
    "type_variant_columns",
]
