from pyspark.sql import functions as F

from tests.helpers import at, raw_trips, rows
from velotide.operators.demand import hourly_demand, hourly_sums
from velotide.operators.trips import (
    clean_trips,
    first_ride_copy,
    parse_trip_times,
    station_dimension,
    trip_events,
    with_both_stations,
)
from velotide.plans.bronze import demand_trips
from velotide.schemas import DEMAND_COLUMNS


def test_earliest_copy_wins_even_without_a_station(spark):
    raw = raw_trips(
        spark,
        {"ride_id": "a", "started_at": "2026-01-05 08:10:01.000"},
        {"ride_id": "a", "started_at": "2026-01-05 08:10:00.000", "end_station_id": None},
        {"ride_id": "b", "started_at": "not a time"},
        {"ride_id": "b", "started_at": "2026-01-05 09:00:00.000"},
        {"ride_id": None},
        {"ride_id": None},
    )
    kept = {r.ride_id: r for r in first_ride_copy(parse_trip_times(raw)).collect()}
    assert len(kept) == 3
    assert kept["a"].end_station_id is None
    assert kept["b"].started_at == at("2026-01-05 09:00:00")
    # The ride is dropped: its first copy lacks a station.
    assert {r.ride_id for r in clean_trips(raw).collect()} == {"b", None}


def test_survivor_does_not_depend_on_partitioning(spark):
    copies = [{"ride_id": str(i % 7), "start_lat": float(i % 5), "start_station_name": f"N{i % 3}"} for i in range(60)]
    raw = raw_trips(spark, *copies)
    results = [rows(clean_trips(raw.repartition(n, F.rand(n)))) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]


def test_ride_with_very_many_copies_is_reduced_before_the_shuffle(spark):
    base = raw_trips(spark, {})
    many = base.crossJoin(spark.range(20_000)).withColumn(
        "ride_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    ).drop("id")
    kept = first_ride_copy(parse_trip_times(many))
    assert kept.count() == 1 + sum(1 for i in range(20_000) if i % 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_demand_path_reads_no_station_attributes(spark, tmp_path):
    raw_trips(spark, {}).write.parquet(str(tmp_path / "raw"))
    hourly = hourly_sums(trip_events(demand_trips(spark.read.parquet(str(tmp_path / "raw")))))
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):].splitlines()[0]
    assert plan.count("FileScan") == 1
    assert "start_lat" not in scan and all(c in scan for c in DEMAND_COLUMNS)


def test_station_minima_are_independent(spark):
    trips = with_both_stations(
        raw_trips(
            spark,
            {"start_station_id": "1.10", "start_station_name": "B", "start_lat": 40.2, "start_lng": -74.3,
             "end_station_id": "1.10", "end_station_name": "A", "end_lat": 40.5, "end_lng": -74.1},
            {"start_station_id": "1.10", "start_station_name": None, "start_lat": None, "start_lng": -74.9,
             "end_station_id": "2.10", "end_station_name": None, "end_lat": None, "end_lng": None},
            {"start_station_id": None},
        )
    )
    assert rows(station_dimension(trips)) == [("1.10", "A", 40.2, -74.9), ("2.10", None, None, None)]


def test_events_and_hourly_ratios(spark):
    raw = raw_trips(
        spark,
        {"ride_id": "a", "rideable_type": "electric_bike"},
        {"ride_id": "b", "member_casual": "casual", "ended_at": "2026-01-05 09:10:00.000"},
        {"ride_id": "c", "rideable_type": None, "ended_at": "broken"},
    )
    events = trip_events(demand_trips(raw))
    assert events.count() == 6
    arrivals = events.where("bike_arrival = 1").select("is_electric", "is_member", "trip_duration_sec").distinct()
    assert rows(arrivals) == [(0, 0, 0.0)]
    got = {(r.station_id, r.event_hour.hour): r for r in hourly_demand(events).collect()}
    assert set(got) == {("1.10", 8), ("2.10", 8), ("2.10", 9)}
    one = got["1.10", 8]
    assert (one.bike_demand, one.dock_demand) == (3, 0)
    assert one.electric_ratio == 1 / 3 and one.member_ratio == 2 / 3
    # The ride without an end counts as a departure but adds no minutes.
    assert one.avg_trip_duration_min == (600 + 3600) / 3 / 60
    assert (got["2.10", 9].electric_ratio, got["2.10", 9].avg_trip_duration_min) == (0.0, 0.0)


def test_totals_are_kept(spark):
    raw = raw_trips(spark, *[
        {"ride_id": str(i % 90), "start_station_id": None if i % 11 == 0 else f"{i % 6}.10",
         "started_at": f"2026-01-{1 + i % 28:02d} {i % 24:02d}:00:00.000",
         "ended_at": f"2026-01-{1 + i % 28:02d} {i % 24:02d}:30:00.000"} for i in range(200)])
    trips = demand_trips(raw)
    total = hourly_sums(trip_events(trips)).agg(F.sum("bike_demand"), F.sum("dock_demand")).first()
    assert tuple(total) == (trips.count(), trips.count())
