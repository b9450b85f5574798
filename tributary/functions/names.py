"""Column references by exact name (dots, spaces and backticks included)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """``F.col`` for a name taken literally, never parsed as a nested path."""
    return F.col("`" + name.replace("`", "``") + "`")
