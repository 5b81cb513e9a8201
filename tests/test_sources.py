import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.helpers import at, rows
from velotide.operators.pricing import price_station_hours
from velotide.schemas import PRICING, RAW_TRIPS
from velotide.session import reducers_for, shuffle_sized_for
from velotide.sources.parquet import read_parquet, write_parquet
from velotide.sources.pricing_table import read_pricing_csv, write_pricing_csv
from velotide.sources.scratch import materialize, scratch_path
from velotide.sources.station_feed import read_station_feed
from velotide.sources.trips import land_trip_files, read_trip_files, with_file_name
from velotide.sources.weather import read_weather

HEADER = ",".join(RAW_TRIPS.fieldNames())


def trip_line(ride, start="6535.10"):
    return f"{ride},electric_bike,2026-01-05 08:00:00.000,2026-01-05 08:09:00.000,A,{start},B,7.20,40.1,-74.1,40.2,-74.2,member"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b 2.csv").write_text(f"{HEADER}\n{trip_line('r3')}\n")
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{trip_line('r1')}\n{trip_line('r2', '')}\n")
    (tmp_path / "notes.txt").write_text("not trips\n")
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "c.csv").write_text(f"{HEADER}\n{trip_line('r9')}\n")
    return str(tmp_path)


def test_scan_reads_the_folder_only_and_keeps_ids_as_text(spark, folder):
    got = {r.ride_id: r.start_station_id for r in read_trip_files(spark, folder).collect()}
    assert got == {"r1": "6535.10", "r2": None, "r3": "6535.10"}


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    bad = trip_line("r2").replace("40.1", "north")
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{trip_line('r1')}\n{bad}\nr3,electric_bike\n")
    got = read_trip_files(spark, str(tmp_path), corrupt_column="line").orderBy("ride_id").collect()
    assert [(r.ride_id, r.start_lat, r.line) for r in got] == [
        ("r1", 40.1, None), ("r2", None, bad), ("r3", None, "r3,electric_bike")]
    assert read_trip_files(spark, str(tmp_path)).count() == 3


def test_file_names(spark, folder):
    got = rows(with_file_name(read_trip_files(spark, folder)).select("ride_id", "file_name"))
    assert got == [("r1", "a.csv"), ("r2", "a.csv"), ("r3", "b%202.csv")]


def test_landing_counts_while_writing(spark, folder, tmp_path):
    out = str(tmp_path / "raw.parquet")
    assert land_trip_files(spark, folder, out) == 3
    landed = read_parquet(spark, out)
    assert landed.count() == 3 and "file_name" in landed.columns


def test_folder_without_files_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_trip_files(spark, str(tmp_path))


def test_other_header_is_refused(spark, tmp_path):
    swapped = HEADER.replace("ride_id,rideable_type", "rideable_type,ride_id")
    (tmp_path / "a.csv").write_text(f"{swapped}\n{trip_line('r1')}\n")
    with pytest.raises(Exception, match="header"):
        read_trip_files(spark, str(tmp_path)).collect()


def test_overwrite_of_the_input_is_refused_and_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(10), path)
    other = spark.range(5).toDF("x")
    for plan in (read_parquet(spark, path).where("id > 3"), other.join(read_parquet(spark, path), F.expr("x = id"))):
        with pytest.raises(ValueError, match="reads the folder"):
            write_parquet(plan, path)
    assert read_parquet(spark, path).count() == 10
    write_parquet(spark.range(3), path)
    write_parquet(spark.range(4), path, mode="append")
    assert read_parquet(spark, path).count() == 7


def test_partitioned_write_is_pruned_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(100).withColumn("month", (F.col("id") % 3).cast("int")), path, partition_by=["month"])
    one = read_parquet(spark, path).where("month = 1")
    assert one.count() == 33
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_station_feed(spark, tmp_path):
    stations = [
        {"station_id": "u1", "lat": 40.73, "lon": -73.99, "capacity": 42, "name": "One"},
        {"station_id": "u2", "lat": 40.75, "lon": -73.95, "name": "Two"},
        {"station_id": "u3", "lat": 0, "lon": -73.95, "capacity": 3},
        {"station_id": "u4", "lat": 40.75, "capacity": 3},
    ]
    path = tmp_path / "feed.json"
    path.write_text(json.dumps({"last_updated": 1, "data": {"stations": stations}}, indent=1))
    got = read_station_feed(spark, str(path))
    assert rows(got) == [("u1", "One", 40.73, -73.99, 42), ("u2", "Two", 40.75, -73.95, 0)]


def test_weather_takes_columns_by_name(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text(
        "latitude,longitude,elevation\n40.7,-74.0,10\n\n"
        "time,wind_speed_10m_max (km/h),sunshine,temperature_2m_mean (°C),precipitation_sum (mm)\n"
        "2026-01-01,11.5,1,-3.5,0.0\n2026-01-02,9.0,2,,1.25\n"
    )
    got = [(str(r[0]), *r[1:]) for r in read_weather(spark, str(path)).orderBy("date").collect()]
    assert got == [("2026-01-01", -3.5, 0.0, 11.5), ("2026-01-02", None, 1.25, 9.0)]
    other = tmp_path / "other.csv"
    other.write_text("time,temperature_2m_mean (°C)\n2026-01-01,1\n")
    with pytest.raises(ValueError, match="lacks"):
        read_weather(spark, str(other))


def test_pricing_csv_round_trip_and_absent_file(spark, tmp_path):
    silver = spark.createDataFrame(
        [("6535.10", at("2026-01-05 08:00:00"), 3, 4, 6), ("7.20", at("2026-01-05 09:00:00"), 30, 0, 0)],
        "station_id string, event_hour timestamp_ntz, bike_demand bigint, dock_demand bigint, capacity int",
    )
    path = str(tmp_path / "pricing")
    table = write_pricing_csv(price_station_hours(silver), path)
    again = read_pricing_csv(spark, path)
    assert again.schema == PRICING and rows(again) == rows(table)
    assert read_pricing_csv(spark, str(tmp_path / "absent")).count() == 0


def test_materialize_writes_under_the_checkpoint_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    table = materialize(spark.range(5).withColumn("x", F.col("id") * 2), "numbers")
    assert rows(table) == [(i, 2 * i) for i in range(5)]
    assert "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()


def test_shuffle_is_sized_for_its_input(spark, tmp_path):
    gib = 1024**3
    assert [reducers_for(n, 200) for n in (0, 10 * gib, 100 * gib, 10**14)] == [200, 200, 400, 100_000]
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    with shuffle_sized_for(spark, path) as reducers:
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(reducers) == "8"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
