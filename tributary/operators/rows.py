"""Rows without a usable schema: naming positional rows (N1) and generic names (N2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed import GENERIC_PREFIX


def _checked_width(df: DataFrame, row: Column, width: int, what: str) -> DataFrame:
    """``df``; a row of another width (or null) raises, whichever columns are selected later."""
    found = F.coalesce(F.size(row).cast("string"), F.lit("no"))
    message = F.concat(F.lit(f"{what}: row has "), found, F.lit(f" values, expected {width}"))
    fits = row.isNotNull() & (F.size(row) == width)
    return df.filter(F.when(fits, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def named_rows(df: DataFrame, names: list[str], row: str = "row",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Positional rows + column names → named columns.

    A row of another width raises. A repeated name keeps its first position and
    the value of its last position (``dict(zip(names, row))``).
    """
    if not names:
        raise ValueError("named_rows needs at least one name")
    last: dict[str, int] = {}
    for i, n in enumerate(names):
        last[n] = i  # first position kept by dict order, value index updated
    r = F.col(row)
    cols = [r[i].alias(n) for n, i in last.items()]
    return _checked_width(df, r, len(names), "named_rows").select(*[F.col(c) for c in keep], *cols)


def generic_columns(df: DataFrame, row: str = "row", order: str | list[str] | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Positional rows without names → ``column_0 … column_{n-1}``.

    ``n`` is the width of the first row by ``order`` (a tiny ``min_by``
    aggregate); a row of another width raises.
    """
    r = F.col(row)
    if order:
        key = F.struct(*[F.col(c) for c in ([order] if isinstance(order, str) else order)])
        width_row = df.agg(F.min_by(F.size(r), key).alias("n")).first()
    else:
        width_row = df.select(F.size(r).alias("n")).first()
    if width_row is None or width_row["n"] is None:
        return df.select(*[F.col(c) for c in keep])
    n = int(width_row["n"])
    cols = [r[i].alias(f"{GENERIC_PREFIX}{i}") for i in range(n)]
    return _checked_width(df, r, n, "generic_columns").select(*[F.col(c) for c in keep], *cols)


def positional(df: DataFrame, cols: list[str] | None = None, as_variant: bool = True) -> Column:
    """Columns of a DataFrame as one positional array (``variant`` items keep mixed kinds)."""
    names = cols or df.columns
    items = [F.col(c).cast("variant") if as_variant else F.col(c) for c in names]
    return F.array(*items)
