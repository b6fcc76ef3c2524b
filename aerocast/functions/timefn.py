"""UTC normalisation and calendar fields (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_utc_instant(x) -> Column:
    """ISO text (naive = UTC, offsets honoured) or timestamp -> TimestampType.

    Unparseable text gives NULL (``try_to_timestamp``), never an error.
    """
    return F.try_to_timestamp(_c(x).cast("string"))


def to_utc_naive(x) -> Column:
    """Same instant as UTC wall-clock ``timestamp_ntz``."""
    return to_utc_instant(x).cast("timestamp_ntz")


def weekday_monday0(ts) -> Column:
    return F.weekday(_c(ts)).cast("long")


def calendar_columns(ts, daily: bool = False) -> list[Column]:
    """hour, month, day, day_of_week (Monday = 0) as bigint.

    On the daily series ``hour`` is the constant 0 that keeps the schema.
    """
    t = _c(ts)
    hour = F.lit(0).cast("long") if daily else F.hour(t).cast("long")
    return [
        hour.alias("hour"),
        F.month(t).cast("long").alias("month"),
        F.dayofmonth(t).cast("long").alias("day"),
        weekday_monday0(t).alias("day_of_week"),
    ]


def floor_day(ts) -> Column:
    return F.date_trunc("day", _c(ts))


def version_stamp(ts) -> Column:
    """UTC ``%Y%m%dT%H%M%SZ`` stamp; sorts as text in time order."""
    return F.date_format(_c(ts), "yyyyMMdd'T'HHmmss'Z'")


def iso_date(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM-dd")
