"""Text helpers: raw-layer timestamp rendering, load stamps and the cron shape check."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed import CRON_PATTERN, LOAD_STAMP_FORMAT, RAW_TS_MICROS, RAW_TS_SECONDS


_CRON_RE = re.compile(CRON_PATTERN)


def is_cron(text: str) -> bool:
    return bool(_CRON_RE.match(text))


def cron_column(col: Column) -> Column:
    return col.rlike(CRON_PATTERN)


def raw_timestamp_text(ts: Column) -> Column:
    """Timestamp → text the way the raw layer renders it."""
    whole_second = F.date_format(ts, "SSSSSS") == "000000"
    return F.when(ts.isNull(), F.lit(None).cast("string")).when(
        whole_second, F.date_format(ts, RAW_TS_SECONDS)
    ).otherwise(F.date_format(ts, RAW_TS_MICROS))


def raw_instant_text(ts: Column) -> Column:
    """Zoned timestamp → its UTC wall clock with the offset, so that the instant stays
    whatever the session's zone is."""
    seconds = (F.unix_micros(ts).cast("decimal(24,0)") / F.lit(1000000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(raw_timestamp_text(utc), F.lit("+00:00"))


def raw_load_stamp(now: _dt.datetime | None = None) -> str:
    """Load id for a raw write: wall clock to the second plus microseconds, so two
    loads in one second do not overwrite each other."""
    now = now or _dt.datetime.now()
    return f"{now.strftime(LOAD_STAMP_FORMAT)}_{now.microsecond:06d}"
