"""Hourly demand kept up to date while trip files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.operators.demand import hourly_aggregates, with_ratios
from velotide.operators.trips import trip_events


def streaming_hourly_demand(trips: DataFrame, lateness: str) -> DataFrame:
    """The batch aggregate with a watermark; an hour is emitted once it closed.

    ``trips`` are clean trips from ``readStream``.  State is one row per station
    and open hour.  Events older than ``lateness`` behind the newest one are
    dropped, without a count but Spark's ``numRowsDroppedByWatermark``: a trip
    arrives when it ends, so ``lateness`` must cover the longest ride and the
    disorder of the files.
    """
    return (
        trip_events(trips)
        .where("event_time IS NOT NULL")
        # Watermarks need the zoned type; the session zone is UTC.
        .withColumn("event_time", F.col("event_time").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .groupBy("station_id", F.window("event_time", "1 hour").alias("hour_window"))
        .agg(*hourly_aggregates())
        .withColumn("event_hour", F.col("hour_window.start").cast("timestamp_ntz"))
        .drop("hour_window")
        .transform(with_ratios)
    )
