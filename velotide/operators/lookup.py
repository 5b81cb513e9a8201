"""Demand lookup cascade: station and hour, hour of day, heuristic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.calendar import hour_of
from velotide.functions.pricing import heuristic_demand
from velotide.operators.skew import left_join_hot_keys


def demand_by_station_hour(history: DataFrame) -> DataFrame:
    return history.groupBy("station_id", "event_hour").agg(
        F.avg("bike_demand").alias("station_bikes"), F.avg("dock_demand").alias("station_docks")
    )


def demand_by_hour_of_day(history: DataFrame) -> DataFrame:
    """Mean over all rows at each hour of day: at most 24 rows, and at most 24
    per task are shuffled."""
    known = history.where("event_hour IS NOT NULL")
    return known.groupBy(F.hour("event_hour").alias("hour_of_day")).agg(
        F.avg("bike_demand").alias("hour_bikes"), F.avg("dock_demand").alias("hour_docks")
    )


@dataclass(frozen=True)
class DemandIndex:
    """What the cascade looks up: one row a station and hour, and one an hour of day (24 at most)."""

    by_station: DataFrame
    by_hour: DataFrame


def demand_index(history: DataFrame) -> DemandIndex:
    """The index of any table of station-hours, as plans: both aggregate when they are used."""
    return DemandIndex(demand_by_station_hour(history), demand_by_hour_of_day(history))


def lookup_demand(requests: DataFrame, history: DataFrame | DemandIndex) -> DataFrame:
    """Adds predicted_bike_demand and predicted_dock_demand to ``requests``.

    ``requests`` has station_id and asked_at; ``history`` is any table of
    station-hours, or the index of one.  The mean of the station at that very
    hour is used, else the mean of all stations at that hour of day, else the
    heuristic.
    """
    index = history if isinstance(history, DemandIndex) else demand_index(history)
    keyed = requests.withColumns(
        {"event_hour": hour_of(F.col("asked_at")), "hour_of_day": F.hour("asked_at")}
    )
    bikes, docks = heuristic_demand(F.col("asked_at"))
    return (
        left_join_hot_keys(keyed, index.by_station, ["station_id", "event_hour"])
        .join(F.broadcast(index.by_hour), "hour_of_day", "left")
        .withColumns(
            {
                "predicted_bike_demand": F.coalesce("station_bikes", "hour_bikes", bikes),
                "predicted_dock_demand": F.coalesce("station_docks", "hour_docks", docks),
            }
        )
        .select(*requests.columns, "predicted_bike_demand", "predicted_dock_demand")
    )


def lookup_horizon(requests: DataFrame, history: DataFrame | DemandIndex, start: Column, hours: int) -> DataFrame:
    """Adds demands: the cascade for each hour of a horizon shared by all rows.

    ``demands`` is an array of (event_hour, bike_demand, dock_demand), so a
    request stays one row: only the station is joined, the history is filtered
    to the horizon in the scan, and the 24 means by hour of day are a single
    value.  An index needs no aggregate of the hours but the one by station.
    """
    end = start + F.make_dt_interval(hours=F.lit(hours - 1))
    horizon = F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))

    def as_map(key: str, bikes: str, docks: str) -> Column:
        value = F.struct(F.col(bikes).alias("bikes"), F.col(docks).alias("docks"))
        return F.map_from_entries(F.collect_list(F.struct(key, value)))

    # At most one entry per hour of the horizon.
    ahead = F.col("event_hour").between(start, end)
    if isinstance(history, DemandIndex):
        at_hours, any_hours = history.by_station.where(ahead), history.by_hour
    else:
        at_hours, any_hours = demand_by_station_hour(history.where(ahead)), demand_by_hour_of_day(history)
    by_station = (
        at_hours.groupBy("station_id")
        .agg(as_map("event_hour", "station_bikes", "station_docks").alias("_at_station"))
    )
    by_hour = any_hours.agg(as_map("hour_of_day", "hour_bikes", "hour_docks"))

    def demand(ts: Column) -> Column:
        own = F.try_element_at(F.col("_at_station"), ts)
        any_station = F.try_element_at(F.col("_at_any"), F.hour(ts))
        bikes, docks = heuristic_demand(ts)
        return F.struct(
            ts.alias("event_hour"),
            F.coalesce(own["bikes"], any_station["bikes"], bikes).alias("bike_demand"),
            F.coalesce(own["docks"], any_station["docks"], docks).alias("dock_demand"),
        )

    return (
        left_join_hot_keys(requests, by_station, ["station_id"])
        .withColumn("_at_any", by_hour.scalar())
        .withColumn("demands", F.transform(horizon, demand))
        .drop("_at_station", "_at_any")
    )
