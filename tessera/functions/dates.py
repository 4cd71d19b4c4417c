"""Date/time arithmetic on text or timestamp columns (session time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import col


def _day(c) -> Column:
    return F.to_date(F.substring(col(c).cast("string"), 1, 10))


def _ts(c) -> Column:
    return F.to_timestamp(col(c).cast("string"))


def diff_days(d1, d2) -> Column:
    """Whole days between the first 10 characters of two date texts."""
    return F.date_diff(_day(d1), _day(d2))


def _diff_floor(t1, t2, unit_seconds: int) -> Column:
    micros = F.unix_micros(_ts(t1)) - F.unix_micros(_ts(t2))
    return F.abs(F.floor(micros / F.lit(unit_seconds * 1_000_000.0))).cast("bigint")


def diff_minutes(t1, t2) -> Column:
    """``abs(seconds // 60)``: floors before the absolute value (-90 s → 2)."""
    return _diff_floor(t1, t2, 60)


def diff_hours(t1, t2) -> Column:
    """``abs(seconds // 3600)``."""
    return _diff_floor(t1, t2, 3600)


def add_days(d, n) -> Column:
    """First 10 characters as a date plus ``n`` days, as ``yyyy-MM-dd``."""
    n = F.lit(n) if isinstance(n, int) else col(n)
    return F.date_format(F.date_add(_day(d), n), "yyyy-MM-dd")


def add_hours(t, n) -> Column:
    """Timestamp plus ``n`` hours, as ``yyyy-MM-dd HH:mm:ss``."""
    n = F.lit(n) if isinstance(n, int) else col(n)
    return F.date_format(F.timestamp_add("HOUR", n, _ts(t)), "yyyy-MM-dd HH:mm:ss")
