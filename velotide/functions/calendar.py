"""Time expressions on zone-free timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
REQUEST_TIME_FORMAT = "yyyy-MM-dd HH:mm"
# Reads that and one-digit months, days, hours and minutes.
REQUEST_TIME_PATTERN = "yyyy-M-d H:m"


def parse_time(text: Column, fmt: str = TRIP_TIME_FORMAT) -> Column:
    """Timestamp of a text, null where it does not have the format."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def duration_seconds(start: Column, end: Column) -> Column:
    """Difference of whole epoch seconds; negative durations are kept."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double")


def is_rush_hour(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(17, 19)


def is_weekend(weekday: Column) -> Column:
    """``weekday`` counts from 1 = Sunday."""
    return weekday.isin(1, 7)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Calendar parts and the two flags, keyed by output column."""
    weekday, hour = F.dayofweek(ts), F.hour(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "weekday": weekday,
        "weekofyear": F.weekofyear(ts),
        "dayofyear": F.dayofyear(ts),
        "hour": hour,
        "is_weekend": is_weekend(weekday).cast("int"),
        "is_rush_hour": is_rush_hour(hour).cast("int"),
    }


def cyclic_columns(name: str, period: int) -> dict[str, Column]:
    angle = F.lit(2.0 * math.pi) * F.col(name) / period
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
