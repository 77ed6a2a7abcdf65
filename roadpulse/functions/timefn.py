"""Time columns. All stamps are TIMESTAMP_NTZ holding UTC, so no expression
here depends on the session time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.columns import UTC, ZONE


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour of an NTZ stamp (date_trunc would pass through the session zone)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.to_date(ts).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.hour(ts), day)


def local_time(utc: Column | str = UTC, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_hour(utc: Column | str = UTC, zone: str = ZONE) -> Column:
    return F.hour(local_time(utc, zone))


def local_weekday(utc: Column | str = UTC, zone: str = ZONE) -> Column:
    """Monday = 0."""
    return F.weekday(local_time(utc, zone))


def hour_of_week(utc: Column | str = UTC, zone: str = ZONE) -> Column:
    """0 (Monday 00:00) to 167 (Sunday 23:00), local time."""
    return local_weekday(utc, zone) * 24 + local_hour(utc, zone)


def cyclic(utc: Column | str = UTC, zone: str = ZONE) -> dict[str, Column]:
    """Hour of day and day of week as points on the unit circle."""
    hod = F.lit(2 * math.pi) * local_hour(utc, zone) / 24
    dow = F.lit(2 * math.pi) * local_weekday(utc, zone) / 7
    return {
        "sin_hod": F.sin(hod),
        "cos_hod": F.cos(hod),
        "sin_dow": F.sin(dow),
        "cos_dow": F.cos(dow),
    }


def minutes_between(earlier: Column | str, later: Column | str) -> Column:
    """Minutes from one NTZ stamp to a later one, from calendar parts (no session zone)."""
    a = F.col(earlier) if isinstance(earlier, str) else earlier
    b = F.col(later) if isinstance(later, str) else later

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts) + F.date_part(F.lit("SECOND"), ts).cast("double") / 60

    return F.datediff(F.to_date(b), F.to_date(a)) * 1440 + of_day(b) - of_day(a)
