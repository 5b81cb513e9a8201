"""Declared table schemas.

Station ids look numeric ("6535.10") but are identifiers: they stay strings,
otherwise trailing zeros are lost and later lookups miss.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def _struct(**columns: str) -> T.StructType:
    """Built without a session, so that modules can be imported before one."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


RAW_TRIPS = _struct(
    ride_id="string",
    rideable_type="string",
    started_at="string",
    ended_at="string",
    start_station_name="string",
    start_station_id="string",
    end_station_name="string",
    end_station_id="string",
    start_lat="double",
    start_lng="double",
    end_lat="double",
    end_lng="double",
    member_casual="string",
)

# What the hourly aggregate needs; everything else is pruned before the
# de-duplication shuffle.
DEMAND_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_id",
    "end_station_id",
    "member_casual",
]

STATION_ATTRIBUTES = [
    "start_station_name",
    "end_station_name",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
]

FEED_STATION = _struct(
    station_id="string", name="string", lat="double", lon="double", capacity="int"
)
STATION_FEED = T.StructType().add("data", T.StructType().add("stations", T.ArrayType(FEED_STATION)))

PRICING = _struct(
    station_id="string",
    event_hour="timestamp",
    bike_demand="bigint",
    dock_demand="bigint",
    capacity="int",
    available_bikes="int",
    available_docks="int",
    bike_gap="bigint",
    dock_gap="bigint",
    pricing_multiplier="double",
    suggested_price="double",
    pricing_zone="string",
)

PRICE_REQUEST = _struct(
    request_id="bigint",
    station_id="string",
    timestamp="string",
    is_holiday="boolean",
    available_bikes="int",
    available_docks="int",
    capacity="int",
)

FORECAST_REQUEST = _struct(
    request_id="bigint",
    station_id="string",
    capacity="int",
    available_bikes="int",
    available_docks="int",
)

# Domain of pricing_zone, in report order.
PRICING_ZONES = ["Surge", "Mild Surge", "Normal", "Discount"]
