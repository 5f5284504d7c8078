"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from addrwatch import config

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def partition_date(year: Column, day: Column) -> Column:
    """Date of a year and day-of-year. Day 366 of a short year rolls over."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)


def transaction_date(year: Column, day: Column) -> Column:
    """The same date read strictly: null where the day does not exist."""
    return F.try_to_date(F.format_string("%d%03d", year, day), "yyyyDDD")


def telemetry_time(ts: Column | None = None, zone: str = config.TELEMETRY_ZONE) -> Column:
    """ISO text of a UTC wall-clock time, now by default, at a fixed offset."""
    utc = F.localtimestamp() if ts is None else ts.cast("timestamp_ntz")
    source = F.current_timezone() if ts is None else F.lit("UTC")
    local = F.convert_timezone(source, F.lit(zone), utc)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall-clock time, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def from_micros(count: Column) -> Column:
    """Wall-clock time of microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", count, F.expr(_EPOCH))


def from_seconds(seconds: Column) -> Column:
    """Wall-clock time of whole seconds since 1970."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))
