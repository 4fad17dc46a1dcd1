"""Time helpers for series rows: day offset + time of day, hour, day parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NS_PER_HOUR = 3_600_000_000_000
US_PER_DAY = 86_400_000_000

# Day-part boundaries in hours, half-open [start, end);
# night wraps around midnight (hour >= 22 or hour < 6).
DAY_PARTS = {
    "morning": (6, 12),
    "afternoon": (12, 18),
    "evening": (18, 22),
    "night": (22, 6),
}
# ISO weekdays counted as weekend (1 = Monday .. 7 = Sunday).
WEEKEND_DAYS = (6, 7)


def time_of_day_ns(c) -> Column:
    """Nanoseconds since midnight from a long, or from 'HH:MM:SS[.fffffffff]'
    text; text that is neither is null."""
    col = (F.col(c) if isinstance(c, str) else c).cast("string")
    clock = r"^(\d{1,2}):(\d{2}):(\d{2}(?:\.\d{1,9})?)$"
    part = lambda i, kind: F.regexp_extract(col, clock, i).try_cast(kind)
    text = (part(1, "long") * 3600 + part(2, "long") * 60) * 1_000_000_000 + (part(3, "decimal(20,9)") * 1_000_000_000).cast("long")
    return F.coalesce(col.try_cast("long"), text)


def hour_of_day(tod_ns: Column) -> Column:
    return F.floor(tod_ns / F.lit(NS_PER_HOUR)).cast("int")


def timestamp_from_offset(day_offset: Column, tod_ns: Column) -> Column:
    """Pseudo-epoch timestamp: 1970-01-01 + day offset + time of day."""
    return F.timestamp_micros(day_offset.cast("long") * US_PER_DAY + F.floor(tod_ns / 1000).cast("long"))


def day_part(hour: Column, name: str) -> Column:
    lo, hi = DAY_PARTS[name]
    if lo < hi:
        return (hour >= lo) & (hour < hi)
    return (hour >= lo) | (hour < hi)


def weekend_flag(weekday: Column) -> Column:
    """True on weekend days; a missing weekday counts as a weekday."""
    return F.coalesce(weekday.isin(*WEEKEND_DAYS), F.lit(False))
