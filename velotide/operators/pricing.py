"""Pricing tables built from the column rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions import pricing as rule
from velotide.functions.rounding import exact_round, whole
from velotide.schemas import PRICING


def with_stock_estimate(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn(
        "available_bikes", rule.estimated_bikes(F.col("capacity"))
    ).withColumn(
        "available_docks", rule.estimated_docks(F.col("capacity"), F.col("available_bikes"))
    )


def with_gaps(stock: DataFrame) -> DataFrame:
    """Available minus demand; negative means shortage."""
    return stock.withColumns(
        {
            "bike_gap": F.col("available_bikes") - F.col("bike_demand"),
            "dock_gap": F.col("available_docks") - F.col("dock_demand"),
        }
    )


def _ratios(gaps: DataFrame) -> DataFrame:
    return gaps.withColumns(
        {
            "_b": rule.gap_ratio(F.col("bike_gap"), F.col("available_bikes")),
            "_d": rule.gap_ratio(F.col("dock_gap"), F.col("available_docks")),
        }
    )


def with_analysis_multiplier(gaps: DataFrame) -> DataFrame:
    return (
        _ratios(gaps)
        .withColumn("pricing_multiplier", rule.analysis_multiplier(F.col("_b"), F.col("_d")))
        .drop("_b", "_d")
    )


def with_analysis_price(priced: DataFrame) -> DataFrame:
    multiplier = F.col("pricing_multiplier")
    return priced.withColumns(
        {
            "suggested_price": rule.analysis_price(multiplier),
            "pricing_zone": rule.analysis_zone(multiplier),
        }
    )


def price_station_hours(silver: DataFrame) -> DataFrame:
    """Every station-hour priced by the analysis rule; no shuffle of its own."""
    return (
        silver.select("station_id", "event_hour", "bike_demand", "dock_demand", "capacity")
        .transform(with_stock_estimate)
        .transform(with_gaps)
        .transform(with_analysis_multiplier)
        .transform(with_analysis_price)
        .select(PRICING.fieldNames())
    )


def decide_prices(requests: DataFrame) -> DataFrame:
    """The decision rule on rows with predicted demand and available stock.

    Adds the gaps, multiplier, price, zone and reason; demand is reported with
    one decimal and gaps as whole numbers, both after the decision is made.
    """
    b, d = F.col("_b"), F.col("_d")
    bike_gap, dock_gap = F.col("_bike_gap"), F.col("_dock_gap")
    bikes, docks = F.col("predicted_bike_demand"), F.col("predicted_dock_demand")
    gaps = requests.withColumns(
        {
            "_bike_gap": F.col("available_bikes") - bikes,
            "_dock_gap": F.col("available_docks") - docks,
        }
    ).withColumns(
        {
            "_b": rule.gap_ratio(bike_gap, F.col("available_bikes")),
            "_d": rule.gap_ratio(dock_gap, F.col("available_docks")),
        }
    )
    return (
        gaps.withColumn("pricing_multiplier", rule.decision_multiplier(b, d))
        .withColumns(
            {
                "predicted_bike_demand": exact_round(bikes, 1),
                "predicted_dock_demand": exact_round(docks, 1),
                "bike_gap": whole(bike_gap),
                "dock_gap": whole(dock_gap),
                "suggested_price_usd": rule.decision_price(F.col("pricing_multiplier")),
                "pricing_zone": rule.decision_zone(b, d),
                "reason": rule.decision_reason(b, d, bike_gap, dock_gap),
            }
        )
        .drop("_b", "_d", "_bike_gap", "_dock_gap")
    )
