"""Which scheduled sources are due in a range of minutes, by native expressions.

A schedule's five fields become bit masks (minute, hour, day, month, weekday); the due
minutes of a source follow from its masks alone, so a table of schedules is matched row by
row: no table of minutes, no join, no shuffle.

Fields are lists of ``*``, ``a`` or ``a-b``, each with ``/step`` if wanted (``a/step`` goes on to
the field's end). Weekday 0 and 7 are Sunday. As usual for cron, where both day and weekday
are restricted (do not begin with ``*``), a day that fits either is due. Values outside a
field, empty ranges and steps of 0 make a schedule invalid: it has the right shape, and is
never due.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import cron_column

# The fields in their order, with their lowest and highest value.
FIELDS = [("minute", 0, 59), ("hour", 0, 23), ("day", 1, 31), ("month", 1, 12), ("weekday", 0, 7)]
_ITEM = "^(\\*|[0-9]{1,4}(-[0-9]{1,4})?)(/[0-9]{1,4})?$"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shift(mask: Column | int, by: Column | int) -> Column:
    bits = F.lit(mask).cast("bigint") if isinstance(mask, int) else mask
    return F.call_function("shiftleft", bits, F.lit(by) if isinstance(by, int) else by)


def _item_mask(item: Column, lo: int, hi: int) -> Column:
    """The values of one item of a field as bits; NULL where the item is invalid."""
    # every step-th bit from bit 0 on, by step; a step beyond the field leaves bit 0
    strides = F.array(*[F.lit(sum(1 << v for v in range(0, 63, step))) for step in range(1, 64)])

    def parsed(parts: Column) -> Column:
        span, step = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        ends = F.split(span, "-")
        first = F.when(span == "*", F.lit(lo)).otherwise(F.get(ends, F.lit(0)).try_cast("int"))
        last = F.when(span == "*", F.lit(hi)).when(F.size(ends) == 2, F.get(ends, F.lit(1)).try_cast("int")) \
            .when(step.isNotNull(), F.lit(hi)).otherwise(first)
        return F.struct(first.alias("first"), last.alias("last"), F.coalesce(step.try_cast("int"), F.lit(1)).alias("by"))

    def mask(i: Column) -> Column:
        fits = (i["first"] >= lo) & (i["last"] <= hi) & (i["first"] <= i["last"]) & (i["by"] >= 1)
        stride = F.get(strides, F.least(i["by"], F.lit(63)) - 1)
        return F.when(fits, _shift(stride, i["first"]).bitwiseAND(_shift(1, i["last"] + 1) - 1))

    return F.when(item.rlike(_ITEM), _once(_once(F.split(item, "/"), parsed), mask))


def field_mask(field: Column, lo: int, hi: int) -> Column:
    """A field's values as bits of a BIGINT; NULL where it is invalid."""
    masks = F.transform(F.split(field, ","), lambda item: _item_mask(item, lo, hi))
    return F.aggregate(masks, F.lit(0).cast("bigint"), lambda m, v: m.bitwiseOR(v))  # NULL stays NULL


def cron_masks(schedule: Column) -> Column:
    """The five masks of a schedule and which day fields are open, as a struct; NULL where it is invalid."""

    def masks(fields: Column) -> Column:
        return F.struct(*[field_mask(F.get(fields, F.lit(k)), lo, hi).alias(name) for k, (name, lo, hi) in enumerate(FIELDS)],
                        F.get(fields, F.lit(2)).startswith("*").alias("any_day"),
                        F.get(fields, F.lit(4)).startswith("*").alias("any_weekday"))

    def valid(m: Column) -> Column:
        all_ = F.lit(True)
        for name, _, _ in FIELDS:
            all_ = all_ & m[name].isNotNull()
        week = m["weekday"]
        sunday = F.when(_has(week, F.lit(7)), (week - (1 << 7)).bitwiseOR(F.lit(1).cast("bigint"))).otherwise(week)
        return F.when(all_, F.struct(*[(sunday if n == "weekday" else m[n]).alias(n) for n, _, _ in FIELDS],
                                     m["any_day"].alias("any_day"), m["any_weekday"].alias("any_weekday")))

    return F.when(cron_column(schedule), _once(_once(F.split(F.trim(schedule), "\\s+"), masks), valid))


def _has(mask: Column, value: Column) -> Column:
    return F.call_function("shiftright", mask, value.cast("int")).bitwiseAND(F.lit(1)) == 1


def _below(mask: Column, value: int) -> Column:
    """The bits of ``mask`` below ``value``."""
    return mask.bitwiseAND(F.lit((1 << value) - 1).cast("bigint"))


def _lowest(mask: Column) -> Column:
    """The place of the lowest bit of a mask that has one."""
    return F.bit_count(mask.bitwiseAND(-mask) - 1)


def _highest(mask: Column) -> Column:
    return F.length(F.bin(mask)) - 1


class _Times:
    """The due minutes of a day (0 to 1439) by the masks of hours and minutes, never listed."""

    def __init__(self, hours: Column, minutes: Column):
        self.hours, self.minutes = hours, minutes
        self.each = F.bit_count(minutes).cast("bigint")

    def count(self, stop: int) -> Column:
        """How many are before ``stop``."""
        hour, rest = divmod(stop, 60)
        here = F.when(_has(self.hours, F.lit(hour)), F.bit_count(_below(self.minutes, rest))).otherwise(0)
        return F.bit_count(_below(self.hours, hour)).cast("bigint") * self.each + here

    def first(self, start: int) -> Column:
        """The first from ``start`` on; NULL if there is none."""
        hour, rest = divmod(start, 60)
        here, later = self.minutes - _below(self.minutes, rest), self.hours - _below(self.hours, hour + 1)
        return F.when(_has(self.hours, F.lit(hour)) & (here != 0), hour * 60 + _lowest(here)) \
            .when(later != 0, _lowest(later) * 60 + _lowest(self.minutes))

    def last(self, stop: int) -> Column:
        """The last before ``stop``; NULL if there is none."""
        hour, rest = divmod(stop, 60)
        here, earlier = _below(self.minutes, rest), _below(self.hours, hour)
        return F.when(_has(self.hours, F.lit(hour)) & (here != 0), hour * 60 + _highest(here)) \
            .when(earlier != 0, _highest(earlier) * 60 + _highest(self.minutes))


def due(sources: DataFrame, start: _dt.datetime, stop: _dt.datetime, schedule: str = "schedule") -> DataFrame:
    """``sources`` with ``valid_schedule``, ``n_due``, ``first_due`` and ``last_due``: the minutes
    from ``start`` up to before ``stop`` (local times without a zone, on any second) at which
    each is due. A source without a schedule has a NULL ``valid_schedule`` and is never due."""
    if stop < start:
        raise ValueError("the range of minutes ends before it begins")
    up = lambda t: (t + _dt.timedelta(seconds=59, microseconds=999_999)).replace(second=0, microsecond=0)
    start, stop = up(start), up(stop)  # a minute is due at its first second
    day0, day1 = start.date(), stop.date()
    minute0, minute1 = start.hour * 60 + start.minute, stop.hour * 60 + stop.minute
    m = F.col("_masks")

    def fits(day: Column) -> Column:
        by_day, by_week = _has(m["day"], F.dayofmonth(day)), _has(m["weekday"], F.dayofweek(day) - 1)
        either = F.when(m["any_day"] | m["any_weekday"], by_day & by_week).otherwise(by_day | by_week)
        return _has(m["month"], F.month(day)) & either

    # columns of their own are worked out once, and not again in each expression that uses them
    masked = sources.withColumn("_masks", cron_masks(F.col(schedule)))
    between = F.array().cast("array<date>")
    if (day1 - day0).days > 1:
        between = F.filter(F.sequence(F.lit(day0 + _dt.timedelta(1)), F.lit(day1 - _dt.timedelta(1))), fits)
    laid = masked.withColumn("_days", between)
    n_days, times = F.size("_days"), _Times(m["hour"], m["minute"])
    first_day, last_day = F.try_element_at("_days", F.lit(1)), F.try_element_at("_days", F.lit(-1))
    on0, on1 = fits(F.lit(day0)), fits(F.lit(day1))
    at = lambda day, minute: day.cast("timestamp_ntz") + F.make_dt_interval(mins=minute)
    # only the first and the last day of the range are cut; all others have every minute of the day
    if day0 == day1:
        n_due = F.when(on0, times.count(minute1) - times.count(minute0))
        found = on0 & (n_due > 0)
        first, last = F.when(found, at(F.lit(day0), times.first(minute0))), F.when(found, at(F.lit(day0), times.last(minute1)))
    else:
        n_due = (F.when(on0, times.count(1440) - times.count(minute0)).otherwise(0) + n_days * times.count(1440)
                 + F.when(on1, times.count(minute1)).otherwise(0))
        whole, tail = n_days > 0, on1 & (times.count(minute1) > 0)
        head = on0 & (times.count(1440) > times.count(minute0))
        first = F.when(head, at(F.lit(day0), times.first(minute0))).when(whole, at(first_day, times.first(0))) \
            .when(tail, at(F.lit(day1), times.first(0)))
        last = F.when(tail, at(F.lit(day1), times.last(minute1))).when(whole, at(last_day, times.last(1440))) \
            .when(head, at(F.lit(day0), times.last(1440)))
    return laid.select(
        *[F.col(f"`{c}`") for c in sources.columns],
        F.when(F.col(schedule).isNotNull(), m.isNotNull()).alias("valid_schedule"),
        F.coalesce(F.when(m.isNotNull(), n_due), F.lit(0)).cast("bigint").alias("n_due"),
        F.when(m.isNotNull(), first).alias("first_due"),
        F.when(m.isNotNull(), last).alias("last_due"))
