"""Views that turn the test tables into the tables a bike network has.

There are no trips among the test tables, so trips are derived from ``events``
by formulas both engines can compute; ``registry.oracles`` states the same
formulas in SQL.  Everything grows with ``events``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.functions.calendar import TRIP_TIME_FORMAT
from velotide.operators.demand import hourly_demand
from velotide.operators.pricing import price_station_hours
from velotide.operators.spatial import match_stations
from velotide.operators.lookup import DemandIndex
from velotide.operators.trips import clean_trips, station_dimension, trip_events, without_station_attributes
from velotide.plans.bronze import demand_trips
from velotide.plans.silver import silver_hours
from velotide.schemas import RAW_TRIPS
from velotide.session import configure
from velotide.sources.demand_index import write_demand_index
from velotide.sources.scratch import materialize, scratch_path

# 2024-01-01 plus this many days is 2026-01-01: two listed holidays fall in.
DAY_SHIFT = 731
AS_OF = "2026-01-15 06:30:00"


def station_id(index: Column) -> Column:
    """Ids that look like numbers but end in a zero."""
    return F.concat(index.cast("string"), F.lit(".10"))


def station_lat(index: Column) -> Column:
    return (index % 200 + 4050) / F.lit(100.0)


def station_lng(index: Column) -> Column:
    return (F.floor(index / 200) - 7400) / F.lit(100.0)


class Tables:
    """Lazily built views, one set per query.

    ``capacities`` and ``silver_table`` are written tables, as between the jobs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet").select(
            "event_id",
            "user_id",
            "event_type",
            (F.col("ts") + F.make_dt_interval(days=F.lit(DAY_SHIFT))).alias("started"),
        )

    @cached_property
    def station_indexes(self) -> DataFrame:
        """Events with the station index of both ends.

        Twenty busy stations take most trips, and every user adds one quiet
        station, so the number of stations grows with the data.
        """
        e, u = F.col("event_id"), F.col("user_id")
        start = F.when(e % 50 == 0, None).when(e % 5 == 2, u + 20).otherwise(u % 20)
        end = F.when(e % 50 == 25, None).when(e % 5 == 3, u + 20).otherwise((u * 7 + e) % 20)
        return self.events.withColumns({"start_s": start, "end_s": end})

    @cached_property
    def raw(self) -> DataFrame:
        """Raw trips with times as text, duplicates and unreadable times."""
        e = F.col("event_id")
        later = F.make_dt_interval(secs=F.col("copy"))
        ride = F.make_dt_interval(secs=e % 3600)
        copies = F.when(e % 40 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        trips = self.station_indexes.withColumn("copy", F.explode(copies))
        started = F.col("started") + later
        columns = {
            "ride_id": e.cast("string"),
            "rideable_type": F.when(F.col("event_type") == "click", "electric_bike").otherwise("classic_bike"),
            "started_at": F.when(e % 250 == 99, F.date_format(started, "yyyy-MM-dd HH:mm"))
            .otherwise(F.date_format(started, TRIP_TIME_FORMAT)),
            "ended_at": F.when(e % 250 == 33, "unknown")
            .otherwise(F.date_format(started + ride, TRIP_TIME_FORMAT)),
            "member_casual": F.when(F.col("user_id") % 3 == 0, "casual").otherwise("member"),
        }
        for side in ("start", "end"):
            s = F.col(f"{side}_s")
            columns[f"{side}_station_name"] = F.concat(F.lit("Station "), s.cast("string"))
            columns[f"{side}_station_id"] = station_id(s)
            columns[f"{side}_lat"] = station_lat(s)
            columns[f"{side}_lng"] = station_lng(s)
        return trips.select(*[columns[c].alias(c) for c in RAW_TRIPS.fieldNames()])

    @cached_property
    def clean(self) -> DataFrame:
        return clean_trips(self.raw)

    @cached_property
    def trips(self) -> DataFrame:
        """Clean trips, narrowed to what demand needs."""
        return demand_trips(self.raw)

    @cached_property
    def bronze(self) -> DataFrame:
        """Clean trips as the bronze job leaves them: de-duplicated once, written."""
        return materialize(self.clean, "bronze")

    @cached_property
    def stations(self) -> DataFrame:
        return station_dimension(self.clean)

    @cached_property
    def feed_stations(self) -> DataFrame:
        """Feed rows as published: some without capacity or usable position."""
        s, kind = F.col("s"), F.col("s") % 4
        lat = station_lat(s) + F.when(kind == 1, 0.0005).when(kind == 3, 0.005).otherwise(0.0)
        lon = station_lng(s) + F.when(kind == 2, 0.00095).otherwise(0.0)
        code = F.concat(F.lit("F"), F.lpad(s.cast("string"), 7, "0"))
        capacity = F.when(s % 8 != 0, s % 6 + 2)
        name = F.concat(F.lit("Dock "), s.cast("string"))

        def entry(feed_id, entry_lat, entry_capacity):
            return F.struct(
                feed_id.alias("station_id"), name.alias("name"), entry_lat.alias("lat"),
                lon.alias("lon"), entry_capacity.cast("int").alias("capacity"),
            )

        entries = F.array(
            entry(code, lat, capacity),
            F.when(s % 5 == 0, entry(F.concat(code, F.lit("b")), lat, F.lit(9))),
            F.when(s % 5 == 1, entry(F.concat(code, F.lit("c")), lat + 0.0003, F.lit(11))),
            F.when(s % 10 == 3, entry(F.concat(code, F.lit("d")), F.lit(0.0), F.lit(5))),
        )
        known = self.station_indexes.select(F.explode(F.array("start_s", "end_s")).alias("s"))
        return (
            known.dropna().distinct()
            .select("s", F.explode(F.array_compact(entries)).alias("station"))
        )

    @cached_property
    def feed_documents(self) -> DataFrame:
        """One JSON text per thousand stations, in the layout of the feed."""
        stations = F.array_sort(F.collect_list("station")).alias("stations")
        return (
            self.feed_stations.groupBy(F.floor(F.col("s") / 1000).alias("page"))
            .agg(stations)
            .select(F.to_json(F.struct(F.struct("stations").alias("data"))).alias("value"))
        )

    @cached_property
    def feed(self) -> DataFrame:
        return self.feed_stations.select("station.*").where("lat <> 0 AND lon <> 0").select(
            F.col("station_id").alias("feed_id"), "name", "lat", "lon",
            F.coalesce("capacity", F.lit(0)).alias("capacity"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """One row per day with trips, days divisible by seven missing."""
        day = F.dayofmonth("date")
        return (
            self.events.select(F.to_date("started").alias("date"))
            .distinct()
            .where(day % 7 != 0)
            .select(
                "date",
                (day - 5).cast("double").alias("temp_c"),
                (day % 4).cast("double").alias("precip_mm"),
                (day % 9 + 10).cast("double").alias("wind_kmh"),
            )
        )

    @cached_property
    def matches(self) -> DataFrame:
        stations = materialize(station_dimension(self.bronze), "stations")
        return match_stations(stations, materialize(self.feed, "feed"))

    @cached_property
    def capacities(self) -> DataFrame:
        return materialize(self.matches, "capacities")

    @cached_property
    def silver(self) -> DataFrame:
        return silver_hours(without_station_attributes(self.bronze), self.capacities, self.weather)

    @cached_property
    def silver_table(self) -> DataFrame:
        """For iterative fits, which read their input several times."""
        return materialize(self.silver, "silver")

    @cached_property
    def hourly_table(self) -> DataFrame:
        """The demand history as lookups find it: a stored table."""
        hourly = hourly_demand(trip_events(self.trips))
        return materialize(
            hourly.select("station_id", "event_hour", "bike_demand", "dock_demand"), "hourly"
        )

    @cached_property
    def demand_index(self) -> DemandIndex:
        """The stored index of that history."""
        return write_demand_index(self.hourly_table, scratch_path(self.spark, "demand-index"))

    @cached_property
    def priced(self) -> DataFrame:
        return price_station_hours(self.silver)

    @cached_property
    def price_requests(self) -> DataFrame:
        """A request per event; a third of them ask for one station and hour.

        Some write their time with single digits, some leave stock or capacity out.
        """
        e, u = F.col("event_id"), F.col("user_id")
        hot = e % 3 == 0
        station = (
            F.when(hot, "7.10").when(e % 10 == 4, "nowhere").otherwise(station_id(u * 3 % 23))
        )
        later = F.col("started") + F.make_dt_interval(hours=F.lit(1))
        asked = F.when(e % 101 == 7, F.date_format(later, "yyyy-M-d H:m")).otherwise(F.date_format(later, "yyyy-MM-dd HH:mm"))
        return self.events.select(
            e.alias("request_id"),
            station.alias("station_id"),
            F.when(e % 97 == 5, "tomorrow").when(hot, "2026-01-15 08:00").otherwise(asked).alias("timestamp"),
            F.lit(False).alias("is_holiday"),
            F.when(e % 20 != 19, (e % 20).cast("int")).alias("available_bikes"),
            F.when(F.floor(e / 3) % 17 != 16, (F.floor(e / 3) % 17).cast("int")).alias("available_docks"),
            F.when(e % 4 != 1, 50).alias("capacity"),
        )

    @cached_property
    def forecast_requests(self) -> DataFrame:
        """A forecast request per user."""
        u = F.col("user_id")
        return self.events.select("user_id").distinct().select(
            u.alias("request_id"),
            F.when(u % 9 == 4, "nowhere").otherwise(station_id(u % 25)).alias("station_id"),
            F.when(u % 13 != 5, (u % 30 + 10).cast("int")).alias("capacity"),
            F.when(u % 18 != 17, (u % 18).cast("int")).alias("available_bikes"),
            F.when(u % 11 != 2, 15).alias("available_docks"),
        )
