"""Clean trips to enriched station-hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotide.operators.demand import hourly_demand, with_calendar, with_cycles
from velotide.operators.enrich import with_capacity, with_holiday, with_weather
from velotide.operators.spatial import match_stations
from velotide.operators.trips import trip_events
from velotide.session import shuffle_sized_for
from velotide.sources.parquet import path_exists, read_parquet, write_parquet
from velotide.sources.scratch import materialized
from velotide.sources.station_feed import read_station_feed
from velotide.sources.weather import read_weather


def silver_hours(trips: DataFrame, capacities: DataFrame, weather: DataFrame | None) -> DataFrame:
    return (
        trips.transform(trip_events)
        .transform(hourly_demand)
        .transform(with_calendar)
        .transform(with_cycles)
        .transform(with_holiday)
        .transform(with_capacity, capacities)
        .transform(with_weather, weather)
    )


def run_silver(
    spark: SparkSession,
    trips_path: str,
    stations_path: str,
    feed_path: str,
    out: str,
    weather_path: str | None = None,
    max_distance_m: float = 100.0,
) -> None:
    """Write station-hours in one folder per month."""
    matches = match_stations(
        read_parquet(spark, stations_path), read_station_feed(spark, feed_path), max_distance_m
    )
    # Without a weather file the stage is left out.
    weather = read_weather(spark, weather_path) if weather_path and path_exists(spark, weather_path) else None
    # As a written table its size is known when the plan is made, so a small one
    # is broadcast and the station-hours are not shuffled for it.
    with materialized(matches, "capacities") as capacities, shuffle_sized_for(spark, trips_path):
        silver = silver_hours(read_parquet(spark, trips_path), capacities, weather)
        write_parquet(silver, out, partition_by=["year", "month"])
