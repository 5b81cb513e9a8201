"""Live station feed: nested JSON with positions and capacities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.schemas import STATION_FEED


def read_station_feed(spark: SparkSession, path: str) -> DataFrame:
    """One row per feed station with usable coordinates.

    A coordinate of zero counts as missing; a missing capacity is zero.
    """
    documents = spark.read.schema(STATION_FEED).option("multiLine", True).json(path)
    return flatten_feed(documents)


def flatten_feed(documents: DataFrame) -> DataFrame:
    station = documents.select(F.inline("data.stations"))
    return station.where("lat <> 0 AND lon <> 0").select(
        F.col("station_id").alias("feed_id"),
        "name",
        "lat",
        "lon",
        F.coalesce("capacity", F.lit(0)).alias("capacity"),
    )
