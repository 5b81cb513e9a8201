"""Left joins that add holiday, weather and capacity to station-hours.

Dimensions carry no broadcast hint unless their size is fixed in code: Spark
broadcasts a side when its file size, or its size measured at run time, is
below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.sources.holidays import holidays


def with_holiday(hourly: DataFrame) -> DataFrame:
    """is_holiday is 1 on a listed day, else 0.  The list is a literal."""
    days = F.broadcast(holidays(hourly.sparkSession))
    return (
        hourly.join(days, F.to_date("event_hour") == F.col("holiday_date"), "left")
        .fillna({"is_holiday": 0})
        .drop("holiday_date")
    )


def with_weather(hourly: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Measures of the day; null on days without weather.  ``None``: no change."""
    if weather is None:
        return hourly
    return hourly.join(weather, F.to_date("event_hour") == F.col("date"), "left").drop("date")


def with_capacity(hourly: DataFrame, capacities: DataFrame) -> DataFrame:
    """Capacity by station, 0 where the station has none.

    A station has at most one row per hour here, so no join key is hot.
    """
    known = capacities.select("station_id", F.col("capacity").cast("int").alias("capacity"))
    return hourly.join(known, "station_id", "left").fillna({"capacity": 0})


def join_coverage(silver: DataFrame) -> DataFrame:
    """Rows, rows with and without weather and non-zero capacities, in one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("temp_c").alias("weather_matched"),
        F.count_if(F.col("temp_c").isNull()).alias("weather_missing"),
        F.count_if(F.col("capacity") > 0).alias("capacity_known"),
    )
