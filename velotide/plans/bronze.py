"""Raw trips to clean trips and the station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from velotide.operators.trips import (
    clean_parsed_trips,
    clean_trips,
    parse_trip_times,
    station_dimension,
    without_station_attributes,
)
from velotide.schemas import DEMAND_COLUMNS
from velotide.session import shuffle_sized_for
from velotide.sources.parquet import read_parquet, write_parquet
from velotide.sources.scratch import materialized
from velotide.sources.trips import CORRUPT_LINE


def demand_trips(raw: DataFrame) -> DataFrame:
    """Clean trips with the columns the hourly aggregate needs.  Narrowed
    before de-duplication, so station attributes are neither read nor shuffled."""
    return raw.select(*DEMAND_COLUMNS).transform(clean_trips)


def run_bronze(spark: SparkSession, raw_path: str, trips_path: str, stations_path: str) -> DataFrame:
    """Write both tables; returns one row of input, output and station counts,
    and of input rows whose start or end time could not be read.

    Trips are de-duplicated once into an intermediate table, from which both
    outputs are projected; the input is counted while that table is written.
    """
    seen = Observation("bronze_input")
    unreadable = F.col("started_at").isNull() | F.col("ended_at").isNull()
    raw = read_parquet(spark, raw_path).drop(CORRUPT_LINE)
    parsed = parse_trip_times(raw).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(unreadable).alias("unreadable")
    )
    with (
        shuffle_sized_for(spark, raw_path),
        materialized(clean_parsed_trips(parsed), "clean-trips") as clean,
    ):
        write_parquet(without_station_attributes(clean), trips_path)
        write_parquet(station_dimension(clean), stations_path)
    counts = (
        seen.get["rows"],
        read_parquet(spark, trips_path).count(),
        read_parquet(spark, stations_path).count(),
        seen.get["unreadable"],
    )
    return spark.createDataFrame(
        [counts],
        "input_rows bigint, output_rows bigint, station_count bigint, unreadable_times bigint",
    )
