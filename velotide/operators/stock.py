"""Running stock of a station, clamped to its docks after every hour.

One hour turns a stock ``x`` into ``min(high, max(low, x + shift))``.  Doing two
such hours in a row is again a step of that form, so hours can be combined in
any grouping.  A long history is therefore cut into weeks: the weeks of all
stations are reduced to one step each in parallel, the steps of a station (one
per week) give the stock at the start of every week, and the hours of a week
are then walked from there.  No task holds more than one week of hours, or one
step per week, of a station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNBOUNDED = 1 << 60


def hourly_shift(bikes: Column, docks: Column) -> Column:
    """Bikes returned minus bikes taken; fractions are cut toward zero."""
    return docks.cast("bigint") - bikes.cast("bigint")


def _clamp(x: Column, low: Column, high: Column) -> Column:
    return F.least(high, F.greatest(low, x))


def _step(shift: Column, low: Column, high: Column) -> Column:
    return F.struct(shift.alias("shift"), low.alias("low"), high.alias("high"))


def _apply(step: Column, stock: Column) -> Column:
    return _clamp(stock + step["shift"], step["low"], step["high"])


def _combine(hours: Column, capacity: Column) -> Column:
    """The single step equal to all ``hours`` in order."""
    start = _step(F.lit(0).cast("bigint"), F.lit(-_UNBOUNDED), F.lit(_UNBOUNDED))
    floor = F.lit(0).cast("bigint")

    def add(done: Column, hour: Column) -> Column:
        shift = hour["shift"]
        return _step(
            done["shift"] + shift,
            _clamp(done["low"] + shift, floor, capacity),
            _clamp(done["high"] + shift, floor, capacity),
        )

    return F.aggregate(hours, start, add)


def _walk(hours: Column, capacity: Column, bikes: Column, docks: Column) -> Column:
    """Stock before each of ``hours``: array of (hour fields..., bikes, docks)."""
    nothing = F.transform(
        F.slice(hours, 1, 0),
        lambda hour: F.struct(hour.alias("hour"), bikes.alias("bikes"), docks.alias("docks")),
    )
    start = F.struct(bikes.alias("bikes"), docks.alias("docks"), nothing.alias("path"))

    def advance(state: Column, hour: Column) -> Column:
        after = _clamp(state["bikes"] + hour["shift"], F.lit(0).cast("bigint"), capacity)
        entry = F.struct(
            hour.alias("hour"), state["bikes"].alias("bikes"), state["docks"].alias("docks")
        )
        return F.struct(
            after.alias("bikes"),
            (capacity - after).alias("docks"),
            F.concat(state["path"], F.array(entry)).alias("path"),
        )

    return F.aggregate(hours, start, advance, lambda state: state["path"])


def _ordered_hours(carried: list[str]) -> Column:
    return F.array_sort(F.collect_list(F.struct("event_hour", *carried, "shift")))


def _typed_stock(station_hours: DataFrame) -> DataFrame:
    whole = {c: F.col(c).cast("bigint") for c in ("capacity", "start_bikes", "start_docks")}
    return station_hours.withColumns(
        {**whole, "shift": hourly_shift(F.col("bike_demand"), F.col("dock_demand"))}
    )


def with_default_stock(station_hours: DataFrame, total_capacity: int = 50) -> DataFrame:
    """Starting stock where none is given: half the capacity, and the rest.

    Needs station_id, event_hour, bike_demand, dock_demand; capacity,
    start_bikes and start_docks are optional columns.
    """
    have = set(station_hours.columns)

    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    return (
        station_hours.withColumn("capacity", given("capacity", F.lit(total_capacity)).cast("bigint"))
        .withColumn("start_bikes", given("start_bikes", F.floor(F.col("capacity") / 2)))
        .withColumn("start_docks", given("start_docks", F.col("capacity") - F.col("start_bikes")))
    )


_STATION = ["capacity", "start_bikes", "start_docks"]


def running_stock(station_hours: DataFrame) -> DataFrame:
    """available_bikes and available_docks before each hour of each station.

    ``station_hours`` has one row per station and hour, with capacity,
    start_bikes and start_docks constant per station (see
    ``with_default_stock``).  The very first hour uses the given docks; later
    ones are what the bikes leave free.
    """
    # Both uses of ``weeks`` have the same filters and need exactly these two
    # aggregates, so the hours are read and shuffled once.
    weeks = (
        _typed_stock(station_hours)
        .withColumn("week", F.date_trunc("week", "event_hour"))
        .where("station_id IS NOT NULL AND week IS NOT NULL")
        .groupBy("station_id", "week")
        .agg(
            _ordered_hours(["bike_demand", "dock_demand"]).alias("hours"),
            F.min(F.struct(*_STATION)).alias("station"),
        )
    )
    step = F.struct("week", _combine(F.col("hours"), F.col("station.capacity")).alias("step"))
    starts = (
        weeks.select("station_id", "station", step.alias("entry"))
        .groupBy("station_id")
        .agg(F.array_sort(F.collect_list("entry")).alias("weeks"), F.min("station").alias("station"))
        .select("station_id", F.inline(_week_starts()))
    )
    capacity = F.col("station.capacity")
    return (
        weeks.join(starts, ["station_id", "week"])
        .select(
            "station_id",
            capacity.alias("capacity"),
            F.inline(_walk(F.col("hours"), capacity, F.col("bikes"), F.col("docks"))),
        )
        .select(
            "station_id",
            "hour.event_hour",
            "hour.bike_demand",
            "hour.dock_demand",
            "capacity",
            F.col("bikes").alias("available_bikes"),
            F.col("docks").alias("available_docks"),
        )
    )


def _week_starts() -> Column:
    """(week, bikes, docks) at the start of each week of a station."""
    weeks = F.col("weeks")
    bikes, docks = F.col("station.start_bikes"), F.col("station.start_docks")
    capacity = F.col("station.capacity")

    def entry(week: Column, stock: Column, free: Column) -> Column:
        return F.struct(week["week"].alias("week"), stock.alias("bikes"), free.alias("docks"))

    nothing = F.transform(F.slice(weeks, 1, 0), lambda week: entry(week, bikes, docks))
    start = F.struct(bikes.alias("bikes"), docks.alias("docks"), nothing.alias("path"))

    def advance(state: Column, week: Column) -> Column:
        after = _apply(week["step"], state["bikes"])
        return F.struct(
            after.alias("bikes"),
            (capacity - after).alias("docks"),
            F.concat(
                state["path"], F.array(entry(week, state["bikes"], state["docks"]))
            ).alias("path"),
        )

    return F.aggregate(weeks, start, advance, lambda state: state["path"])


def walk_demands(requests: DataFrame) -> DataFrame:
    """One row per hour of each request's ``demands``, with the stock before it.

    The walk happens inside the row; nothing is grouped or shuffled.
    """
    hours = F.transform(
        "demands",
        lambda d: F.struct(
            d["event_hour"].alias("event_hour"),
            d["bike_demand"].alias("bike_demand"),
            d["dock_demand"].alias("dock_demand"),
            hourly_shift(d["bike_demand"], d["dock_demand"]).alias("shift"),
        ),
    )
    stock = [F.col(c).cast("bigint") for c in _STATION]
    rest = [c for c in requests.columns if c not in ("demands", "start_bikes", "start_docks")]
    return requests.select(*rest, F.inline(_walk(hours, *stock))).select(
        *rest,
        "hour.event_hour",
        "hour.bike_demand",
        "hour.dock_demand",
        F.col("bikes").alias("available_bikes"),
        F.col("docks").alias("available_docks"),
    )
