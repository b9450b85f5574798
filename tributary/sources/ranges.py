"""Ranges of a column that hold about equal numbers of rows, as predicates.

Equal strides give one task most of the rows where values are skewed. Here the bounds come
from a quantile sketch (one aggregation, merged from all tasks), NULLs have ranges of their
own, and a value that fills a range by itself is split by a second column.
"""

from __future__ import annotations

import datetime as _dt
import decimal
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps of the sketch for each wanted range: ranges are packed from steps.
STEPS = 8
ACCURACY = 100_000


@dataclass(frozen=True)
class Bound:
    """One side of a range; None is open."""

    value: object
    closed: bool


def literal(value: object) -> str:
    """A value in SQL."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def _between(column: str, low: Bound | None, high: Bound | None) -> str:
    if low and high and low.closed and high.closed and low.value == high.value:
        return f"{column} = {literal(low.value)}"
    parts = []
    if low:
        parts.append(f"{column} {'>=' if low.closed else '>'} {literal(low.value)}")
    if high:
        parts.append(f"{column} {'<=' if high.closed else '<'} {literal(high.value)}")
    return " AND ".join(parts) or f"{column} IS NOT NULL"


def _packed(points: list, steps: int) -> list[tuple[Bound | None, Bound | None, int]]:
    """Quantiles (a value as often as it is one) → ranges of at most ``steps`` of them, in
    order and without gaps; a value of more is a range of its own. With how many each has."""
    counted: dict = {}
    for p in points:
        counted[p] = counted.get(p, 0) + 1
    out, low, have = [], None, 0
    for value, n in counted.items():
        if n > steps or have + n > steps:
            if low is not None or have or not out:
                out.append((low, Bound(value, False), have))
            low, have = Bound(value, True), 0
        if n > steps:
            out.append((low, Bound(value, True), n))
            low = Bound(value, False)
        else:
            have += n
    out.append((low, None, have))
    return out


def _quantiles(df: DataFrame, column: str, n: int) -> list:
    if n < 1:
        return []
    at = [k / (n + 1) for k in range(1, n + 1)]
    found = df.agg(F.percentile_approx(F.col(column), at, ACCURACY).alias("q")).first()["q"]
    return list(found or [])


def equal_ranges(df: DataFrame, column: str, parts: int, second: str | None = None, quote: str = "`") -> list[str]:
    """Predicates that part ``df``: every row fits exactly one, and each has about 1 / ``parts`` of the rows.

    ``second`` parts the rows of a value that is too frequent, and of NULL; without it they
    stay together. Bounds come from a sketch of relative error 1 / ACCURACY; the number of
    predicates is between ``parts`` / 2 and 2 ``parts`` + 2, a few more with NULLs. Only the
    bounds reach the driver. Columns are numbers, dates or times: the sketch needs an order of
    numbers.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    name, other = (f"{quote}{c}{quote}" if c else None for c in (column, second))
    total = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(column)).alias("k")).first()
    nulls, each = total["n"] - total["k"], max(1, -(-total["n"] // parts))
    steps = STEPS * max(1, round(total["k"] / each))
    out = []

    def split(rows: DataFrame, predicate: str, n: int) -> None:
        """The rows of one value (or of NULL), parted by the second column."""
        if not second or n < 2:
            out.append(predicate)
            return
        ranges = _packed(_quantiles(rows, second, STEPS * n), STEPS)
        for k, (low, high, _) in enumerate(ranges):
            own = _between(other, low, high)
            out.append(f"{predicate} AND {f'({own} OR {other} IS NULL)' if k == 0 else own}")

    for low, high, n in _packed(_quantiles(df, column, steps), STEPS):
        alone = low and high and low.value == high.value and high.closed
        if alone:
            split(df.where(F.col(column) == F.lit(low.value)), _between(name, low, high), -(-n // STEPS))
        else:
            out.append(_between(name, low, high))
    if nulls:
        split(df.where(F.col(column).isNull()), f"{name} IS NULL", -(-nulls // each))
    return out
