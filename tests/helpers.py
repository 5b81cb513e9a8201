"""Small builders shared by the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from velotide.schemas import RAW_TRIPS


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def raw_trips(spark, *trips: dict):
    """Raw trips with defaults for whatever a test does not mention."""
    base = {
        "ride_id": "r",
        "rideable_type": "classic_bike",
        "started_at": "2026-01-05 08:10:00.000",
        "ended_at": "2026-01-05 08:20:00.000",
        "start_station_id": "1.10",
        "end_station_id": "2.10",
        "start_station_name": "One",
        "end_station_name": "Two",
        "start_lat": 40.0,
        "start_lng": -74.0,
        "end_lat": 41.0,
        "end_lng": -73.0,
        "member_casual": "member",
    }
    table = [tuple({**base, **trip}[c] for c in RAW_TRIPS.fieldNames()) for trip in trips]
    return spark.createDataFrame(table, RAW_TRIPS)


def hours(spark, table: list[tuple], columns: str):
    """Rows whose event_hour is given as text."""
    df = spark.createDataFrame(table, columns)
    return df.withColumn("event_hour", F.col("event_hour").cast("timestamp_ntz"))
