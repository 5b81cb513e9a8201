"""Price requests and forecasts answered in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions.calendar import REQUEST_TIME_FORMAT, REQUEST_TIME_PATTERN, hour_of, parse_time
from velotide.operators.lookup import DemandIndex, lookup_demand, lookup_horizon
from velotide.operators.pricing import decide_prices
from velotide.operators.stock import running_stock, walk_demands, with_default_stock

FORECAST_HOURS = 24

RESPONSE = [
    "station_id",
    "timestamp",
    "predicted_bike_demand",
    "predicted_dock_demand",
    "pricing_multiplier",
    "suggested_price_usd",
    "pricing_zone",
    "reason",
]
TIME_ERROR = f"timestamp must have the format '{REQUEST_TIME_FORMAT}'"


# What a request that leaves them out is taken to say.
REQUEST_DEFAULTS = {"available_bikes": 15, "available_docks": 15, "capacity": 50}


def with_defaults(requests: DataFrame) -> DataFrame:
    """Null or absent stock and capacity replaced by the request defaults."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in requests.columns else F.lit(v) for c, v in REQUEST_DEFAULTS.items()
    }
    return requests.withColumns(filled)


def checked_requests(requests: DataFrame) -> DataFrame:
    """Adds asked_at and error; a timestamp of another form sets the error."""
    asked_at = parse_time(F.col("timestamp"), REQUEST_TIME_PATTERN)
    return requests.withColumn("asked_at", asked_at).withColumn(
        "error", F.when(F.col("asked_at").isNull(), TIME_ERROR)
    )


def answer_requests(requests: DataFrame, history: DataFrame | DemandIndex) -> DataFrame:
    """One answer per request: the eight response columns and error.

    A refused request keeps its row, with the error and no price.
    """
    checked = checked_requests(with_defaults(requests)).select(
        "request_id", "station_id", "timestamp", "available_bikes", "available_docks", "asked_at", "error"
    )
    answers = decide_prices(lookup_demand(checked, history))
    priced = {
        c: F.when(F.col("error").isNull(), F.col(c)) for c in RESPONSE if c not in ("station_id", "timestamp")
    }
    return answers.withColumns(priced).select("request_id", *RESPONSE, "error")


def forecast(requests: DataFrame, history: DataFrame | DemandIndex, as_of: str) -> DataFrame:
    """24 hourly decisions per request from the hour of ``as_of`` on.

    Stock moves with the predicted demand from hour to hour.
    """
    start = hour_of(F.lit(as_of).cast("timestamp_ntz"))
    stock = {"available_bikes": "start_bikes", "available_docks": "start_docks"}
    asked = with_defaults(requests).withColumnsRenamed(stock)
    walked = walk_demands(lookup_horizon(asked, history, start, FORECAST_HOURS)).withColumnsRenamed(
        {"bike_demand": "predicted_bike_demand", "dock_demand": "predicted_dock_demand"}
    )
    return decide_prices(walked).select(
        "request_id",
        "station_id",
        "capacity",
        F.date_format("event_hour", REQUEST_TIME_FORMAT).alias("timestamp"),
        "predicted_bike_demand",
        "predicted_dock_demand",
        "pricing_multiplier",
        "suggested_price_usd",
        "pricing_zone",
    )


def price_series(station_hours: DataFrame, total_capacity: int = 50) -> DataFrame:
    """Decisions along each station's hours with running stock (twelve columns)."""
    stock = running_stock(with_default_stock(station_hours, total_capacity))
    return decide_prices(
        stock.withColumnsRenamed(
            {"bike_demand": "predicted_bike_demand", "dock_demand": "predicted_dock_demand"}
        )
    ).select(
        "station_id",
        F.date_format("event_hour", REQUEST_TIME_FORMAT).alias("timestamp"),
        "predicted_bike_demand",
        "predicted_dock_demand",
        F.col("available_bikes").alias("available_bikes_now"),
        F.col("available_docks").alias("available_docks_now"),
        "bike_gap",
        "dock_gap",
        "pricing_multiplier",
        "suggested_price_usd",
        "pricing_zone",
        "reason",
    )
