"""Event time from the four log formats, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline import fixed_values as V

_ZONED = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"
    r"(?:Z|[+-][0-9]{2}:?[0-9]{2})\z"
)
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def iso_instant(text: Column) -> Column:
    """An ISO 8601 text with a zone as TIMESTAMP, NULL for anything else."""
    return F.when(text.rlike(_ZONED), text.try_cast("timestamp"))


def utc_clock(instant: Column) -> Column:
    """The instant's UTC wall clock as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def utc_minute(instant: Column) -> Column:
    """The UTC minute the instant lies in, as TIMESTAMP_NTZ."""
    minutes = F.lit(60) * F.floor(F.unix_seconds(instant) / F.lit(60))
    return F.timestamp_add("SECOND", minutes, F.expr(_EPOCH))


def utc_text(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return F.substring(utc_clock(instant).cast("string"), 1, 19)


def access_time(timestamp: Column) -> Column:
    return F.try_to_timestamp(timestamp, F.lit(V.ACCESS_TIME_FORMAT))


def error_time(timestamp: Column) -> Column:
    """The captured text ends in a blank; the clock is at a fixed offset."""
    return F.try_to_timestamp(
        F.concat(F.trim(timestamp), F.lit(f" {V.ERROR_TIME_OFFSET}")),
        F.lit(f"{V.ERROR_TIME_FORMAT} Z"),
    )


def window_time(formatted: Column) -> Column:
    """The formatted creation time is a UTC clock."""
    return iso_instant(F.concat(F.replace(formatted, F.lit(" "), F.lit("T")), F.lit("Z")))


def api_time(timestamp: Column) -> Column:
    return F.try_to_timestamp(timestamp, F.lit(V.API_TIME_FORMAT))


def not_after(event_time: Column, ingest_time: Column) -> Column:
    """Event time capped at ingest time, so one future row moves no watermark."""
    return F.least(F.coalesce(event_time, ingest_time), ingest_time)
