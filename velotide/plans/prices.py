"""Station-hours to prices, and prices to reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotide.operators.pricing import price_station_hours
from velotide.operators.reports import zone_summary
from velotide.sources.parquet import read_parquet, write_parquet
from velotide.sources.pricing_table import write_pricing_csv


def run_pricing(
    spark: SparkSession, silver_path: str, csv_out: str, parquet_out: str | None = None
) -> DataFrame:
    """Price all station-hours; writes CSV (and Parquet, for scans that prune)
    and returns the table."""
    priced = price_station_hours(read_parquet(spark, silver_path))
    if parquet_out:
        write_parquet(priced, parquet_out)
        priced = read_parquet(spark, parquet_out)
    return write_pricing_csv(priced, csv_out)


def pricing_summary(priced: DataFrame) -> DataFrame:
    return zone_summary(priced)
