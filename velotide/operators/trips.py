"""Cleaning trips, the station dimension, and the split into events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.functions.calendar import duration_seconds, parse_time
from velotide.schemas import STATION_ATTRIBUTES


def parse_trip_times(trips: DataFrame) -> DataFrame:
    """Texts to timestamps; a text in another format becomes null."""
    return trips.withColumns(
        {name: parse_time(F.col(name)) for name in ("started_at", "ended_at")}
    )


# Which copy of a ride is the first: compared in this order, nulls last.  The
# tail makes the order total, so the survivor does not depend on partitioning.
_RIDE_ORDER = [
    "started_at",
    "ended_at",
    "start_station_id",
    "end_station_id",
    "rideable_type",
    "member_casual",
    *STATION_ATTRIBUTES,
]


def first_ride_copy(trips: DataFrame) -> DataFrame:
    """One row per ride_id, the earliest copy.

    ``row_number() = 1`` is executed with a group limit below the shuffle: each
    task keeps one row per ride, so a ride with very many copies reaches its
    reducer as one row per task.  Only columns ``trips`` has take part, so
    callers narrow the frame first to shuffle less.
    """
    order = [F.col(c).asc_nulls_last() for c in _RIDE_ORDER if c in trips.columns]
    rank = F.row_number().over(Window.partitionBy("ride_id").orderBy(*order))
    return trips.withColumn("_copy", rank).where("_copy = 1").drop("_copy")


def with_both_stations(trips: DataFrame) -> DataFrame:
    return trips.where("start_station_id IS NOT NULL AND end_station_id IS NOT NULL")


def without_station_attributes(trips: DataFrame) -> DataFrame:
    return trips.drop(*STATION_ATTRIBUTES)


def clean_parsed_trips(parsed: DataFrame) -> DataFrame:
    """De-duplicated trips that have both stations."""
    return parsed.transform(first_ride_copy).transform(with_both_stations)


def clean_trips(raw: DataFrame) -> DataFrame:
    return raw.transform(parse_trip_times).transform(clean_parsed_trips)


def trip_ends_as_stations(trips: DataFrame) -> DataFrame:
    """Both ends of every trip as station rows, from one read of the trips."""
    ends = [
        F.struct(
            F.col(f"{side}_station_id").alias("station_id"),
            F.col(f"{side}_station_name").alias("name"),
            F.col(f"{side}_lat").alias("latitude"),
            F.col(f"{side}_lng").alias("longitude"),
        )
        for side in ("start", "end")
    ]
    return trips.select(F.inline(F.array(*ends)))


def station_dimension(trips: DataFrame) -> DataFrame:
    """Per station the smallest name, latitude and longitude, each on its own.

    A minimum over strings cannot use hash aggregation, so names are made part
    of the key first: numbers are reduced with a hash aggregate per (station,
    name), and only that small result is reduced by name.
    """
    per_name = (
        trip_ends_as_stations(trips)
        .groupBy("station_id", "name")
        .agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    )
    return per_name.groupBy("station_id").agg(
        F.min("name").alias("name"),
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
    )


def trip_events(trips: DataFrame) -> DataFrame:
    """A departure and an arrival per trip, from one read of the trips.

    Bike kind, membership and duration travel with the departure only.
    """
    electric = F.when(F.col("rideable_type") == "electric_bike", 1).otherwise(0)
    member = F.when(F.col("member_casual") == "member", 1).otherwise(0)
    none = F.lit(0)
    sides = {
        "departure": ("started_at", "start_station_id", F.lit(1), none, electric, member,
                      duration_seconds(F.col("started_at"), F.col("ended_at"))),
        "arrival": ("ended_at", "end_station_id", none, F.lit(1), none, none, F.lit(0.0)),
    }
    rows = [
        F.struct(
            F.col(time).alias("event_time"),
            F.col(station).alias("station_id"),
            departures.alias("bike_departure"),
            arrivals.alias("bike_arrival"),
            is_electric.alias("is_electric"),
            is_member.alias("is_member"),
            seconds.alias("trip_duration_sec"),
        )
        for time, station, departures, arrivals, is_electric, is_member, seconds in sides.values()
    ]
    return trips.select(F.inline(F.array(*rows)))
