"""Scalar column helpers (all native Spark expressions, no Python UDFs)."""

from tributary.functions.json import as_array, as_object, is_empty_container, parse_body, variant_text
from tributary.functions.names import column
from tributary.functions.text import CRON_PATTERN, cron_column, is_cron, raw_load_stamp, raw_timestamp_text

__all__ = [
    "CRON_PATTERN",
    "as_array",
    "as_object",
    "column",
    "cron_column",
    "is_cron",
    "is_empty_container",
    "parse_body",
    "raw_load_stamp",
    "raw_timestamp_text",
    "variant_text",
]
