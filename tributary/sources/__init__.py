"""Source connectors and the type registry (P5).

Types are looked up case-insensitively. ``odbc`` is accepted as an alias of
``jdbc`` so existing pipeline files keep their type names.
"""

from __future__ import annotations

from tributary.sources.documents import read_documents
from tributary.sources.jdbc import DEFAULT_TABLE, JdbcSource, jdbc_write
from tributary.sources.rest import RESPONSE_SCHEMA, RestJsonDataSource, RestSource

SOURCE_TYPES: dict[str, type] = {"jdbc": JdbcSource, "odbc": JdbcSource, "api": RestSource}


def supported_types() -> list[str]:
    return sorted(SOURCE_TYPES)


def is_supported_type(name: str | None) -> bool:
    return bool(name) and str(name).lower() in SOURCE_TYPES


def register_type(name: str, cls: type) -> None:
    """Plug in a new connector class (it needs ``__init__(spec)`` and ``read(spark)``)."""
    SOURCE_TYPES[name.lower()] = cls


def source_for(spec):
    if not is_supported_type(spec.src_type):
        known = ", ".join(supported_types())
        raise ValueError(f"no connector reads sources of type {spec.src_type!r} (there are: {known})")
    return SOURCE_TYPES[spec.src_type.lower()](spec)


__all__ = [
    "DEFAULT_TABLE",
    "RESPONSE_SCHEMA",
    "SOURCE_TYPES",
    "JdbcSource",
    "RestJsonDataSource",
    "RestSource",
    "is_supported_type",
    "jdbc_write",
    "read_documents",
    "register_type",
    "source_for",
    "supported_types",
]
