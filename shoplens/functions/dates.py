"""Date functions on epoch milliseconds (D1-D6), in the session time zone.

The milliseconds of the input survive the rounding, as in ``...04.204`` ->
``...00.204``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _floor(ms: Column | str, unit: str) -> Column:
    ms = _col(ms)
    return F.unix_millis(F.date_trunc(unit, F.timestamp_millis(ms))) + F.pmod(ms, F.lit(1000))


def start_of_day(ms: Column | str) -> Column:
    """D1."""
    return _floor(ms, "day")


def end_of_day(ms: Column | str) -> Column:
    """23:59:59 of the day."""
    ms = _col(ms)
    day = F.date_trunc("day", F.timestamp_millis(ms))
    following = (day.cast("date") + F.expr("INTERVAL 1 DAY")).cast("timestamp")  # days of 23 or 25 hours too
    return F.unix_millis(following) - 1000 + F.pmod(ms, F.lit(1000))


def floor_hour(ms: Column | str) -> Column:
    """D3."""
    return _floor(ms, "hour")


def next_hour(ms: Column | str) -> Column:
    """One hour after the floor, also for a full hour."""
    return _floor(ms, "hour") + F.lit(3_600_000)


def day_string(ms: Column | str) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd")


def window_end_string(ms: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss.S``."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd HH:mm:ss.S")
