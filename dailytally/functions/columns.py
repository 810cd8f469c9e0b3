"""Column expressions (all built-in, JVM side, inside whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from dailytally.config import DATE_TEXT_FORMAT, STATUS_CANCELLED, STATUS_COMPLETED


def ts_ntz(value: _dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (never zone-shifted)."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: _dt.date | str) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value), DATE_TEXT_FORMAT)


def order_date(created_at: str | Column = "created_at") -> Column:
    """Reporting day of an order: calendar date of its creation time."""
    c = F.col(created_at) if isinstance(created_at, str) else created_at
    return F.to_date(c)


def day_start(d: str | Column) -> Column:
    """Midnight of a date as TIMESTAMP_NTZ."""
    c = F.col(d) if isinstance(d, str) else d
    return c.cast("timestamp_ntz")


def day_floor(ts: str | Column) -> Column:
    """Timestamp truncated to its day, staying TIMESTAMP_NTZ.

    Goes through DATE rather than ``date_trunc`` (which yields a zoned
    timestamp in Spark 4.1, so a cast back would depend on the zone).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c).cast("timestamp_ntz")


def sub_millis_micros(ts: str | Column) -> Column:
    """Microseconds below the millisecond (0..999) of an NTZ timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    secs = F.date_part(F.lit("SECOND"), c)  # decimal(8,6): seconds with fraction
    return (secs * 1_000_000).cast("long") % 1000


def ntz_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (no zone involved)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(F.to_date(c)).cast("long")
    hm = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
    secs = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return days * 86_400_000_000 + hm * 1_000_000 + secs


def ceil_millis(ts: str | Column) -> Column:
    """Round a timestamp up to the next whole millisecond.

    An exact millisecond is unchanged; otherwise the next millisecond,
    carrying into seconds, minutes and days. For stores that keep ms only.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    pad = (F.lit(1000) - sub_millis_micros(c)) % 1000
    step = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (pad.cast("decimal(18,6)") / F.lit(1_000_000)).cast("decimal(18,6)")
    )
    return (c + step).cast("timestamp_ntz")


def iso_date(d: str | Column) -> Column:
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, DATE_TEXT_FORMAT)


def parse_iso_date(s: str | Column) -> Column:
    """Text ``YYYY-MM-DD`` to DATE; under ANSI mode bad text raises."""
    c = F.col(s) if isinstance(s, str) else s
    return F.to_date(c, DATE_TEXT_FORMAT)


def is_completed(status: str = "status") -> Column:
    return F.col(status) == F.lit(STATUS_COMPLETED)


def is_cancelled(status: str = "status") -> Column:
    return F.col(status) == F.lit(STATUS_CANCELLED)
