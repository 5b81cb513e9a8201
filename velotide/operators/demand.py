"""Hourly demand per station and the features derived from the hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.calendar import calendar_columns, cyclic_columns, hour_of


# The sums of an hour's events, for tables and streams.
_SUMS = {
    "bike_demand": "bike_departure",
    "dock_demand": "bike_arrival",
    "electric_count": "is_electric",
    "member_count": "is_member",
    "total_duration_sec": "trip_duration_sec",
}


def hourly_aggregates() -> list[Column]:
    return [F.sum(source).alias(name) for name, source in _SUMS.items()]


def hourly_sums(events: DataFrame) -> DataFrame:
    """Sums per station and hour; events without a time are left out.

    All buffers are numbers, so this is a hash aggregate with a partial step:
    a station with most of the traffic still reaches its reducer as one row per
    hour and task.
    """
    return (
        events.where("event_time IS NOT NULL")
        .groupBy("station_id", hour_of(F.col("event_time")).alias("event_hour"))
        .agg(*hourly_aggregates())
    )


def with_ratios(hourly: DataFrame) -> DataFrame:
    """Shares and mean minutes of the departures; zero without departures."""
    departures = F.col("bike_demand")

    def guarded(value):
        return F.when(departures > 0, value).otherwise(F.lit(0.0))

    return hourly.withColumns(
        {
            "electric_ratio": guarded(F.col("electric_count") / departures),
            "member_ratio": guarded(F.col("member_count") / departures),
            "avg_trip_duration_min": guarded(F.col("total_duration_sec") / departures / 60.0),
        }
    ).drop("electric_count", "member_count", "total_duration_sec")


def hourly_demand(events: DataFrame) -> DataFrame:
    return events.transform(hourly_sums).transform(with_ratios)


def with_calendar(hourly: DataFrame) -> DataFrame:
    return hourly.withColumns(calendar_columns(F.col("event_hour")))


def with_cycles(hourly: DataFrame) -> DataFrame:
    return hourly.withColumns({**cyclic_columns("hour", 24), **cyclic_columns("weekday", 7)})
