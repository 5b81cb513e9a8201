import json

from pyspark.sql import functions as F

import __spark_entry__ as contract
from registry import check
from registry.adapter import AS_OF, Tables
from registry.oracles import ORACLES
from registry.queries import registered
from tests.helpers import rows
from velotide.__main__ import main
from velotide.operators.demand import hourly_demand
from velotide.operators.trips import parse_trip_times, trip_events
from velotide.plans.bronze import run_bronze
from velotide.plans.gold import run_gold
from velotide.plans.prices import pricing_summary, run_pricing
from velotide.plans.serving import forecast
from velotide.plans.silver import run_silver, silver_hours
from velotide.schemas import PRICING
from velotide.sources.holidays import HOLIDAYS
from velotide.sources.parquet import read_parquet
from velotide.sources.pricing_table import read_pricing_csv
from velotide.sources.trips import land_trip_files
from velotide.streaming.hourly import streaming_hourly_demand

SF = "/root/testdata/sf0.001"


def test_files_to_prices(spark, tmp_path):
    """The jobs one after the other, from CSV files to the priced table."""
    paths = {n: str(tmp_path / n) for n in ("csv", "raw", "trips", "stations", "feed", "silver", "gold", "model", "prices", "table")}
    t = Tables(spark, SF)
    t.raw.write.option("header", True).csv(paths["csv"])
    t.feed_documents.write.option("maxRecordsPerFile", 1).text(paths["feed"])
    weather = tmp_path / "weather.csv"
    lines = [f"{r.date},{r.temp_c},{r.precip_mm},{r.wind_kmh}" for r in t.weather.collect()]
    header = "time,temperature_2m_mean (°C),precipitation_sum (mm),wind_speed_10m_max (km/h)"
    weather.write_text("\n".join(["a,b", "1,2", "", header, *lines]) + "\n")

    assert land_trip_files(spark, paths["csv"], paths["raw"]) == t.raw.count()
    counts = run_bronze(spark, paths["raw"], paths["trips"], paths["stations"]).first()
    unreadable = parse_trip_times(t.raw).where("started_at IS NULL OR ended_at IS NULL").count()
    assert tuple(counts) == (t.raw.count(), t.clean.count(), t.stations.count(), unreadable) and unreadable > 0
    run_silver(spark, paths["trips"], paths["stations"], paths["feed"], paths["silver"], str(weather))
    silver = read_parquet(spark, paths["silver"])
    assert rows(silver.select(t.silver.columns)) == rows(t.silver)

    table = run_pricing(spark, paths["silver"], paths["prices"], paths["table"])
    assert table.columns == PRICING.fieldNames()
    assert rows(read_pricing_csv(spark, paths["prices"])) == rows(t.priced)
    assert sum(r.zone_rows for r in pricing_summary(table).collect()) == silver.count()

    run_gold(spark, paths["silver"], paths["gold"], paths["model"], k=5)
    # Hours whose trips all lack an end have no mean duration and are skipped too.
    complete = silver.dropna(subset=["temp_c", "avg_trip_duration_min"]).count()
    assert read_parquet(spark, paths["gold"]).count() == complete


def test_silver_without_weather(spark, tmp_path):
    t = Tables(spark, SF)
    feed = {"data": {"stations": [{"station_id": "f", "lat": 40.5, "lon": -74.0, "capacity": 8}]}}
    (tmp_path / "feed.json").write_text(json.dumps(feed))
    t.trips.write.parquet(str(tmp_path / "trips"))
    t.stations.write.parquet(str(tmp_path / "stations"))
    run_silver(spark, str(tmp_path / "trips"), str(tmp_path / "stations"), str(tmp_path / "feed.json"), str(tmp_path / "out"))
    silver = read_parquet(spark, str(tmp_path / "out"))
    assert "temp_c" not in silver.columns
    assert rows(silver.where("capacity > 0").select("station_id", "capacity").distinct()) == [("0.10", 8)]


def test_stream_equals_batch(spark, tmp_path):
    trips = Tables(spark, SF).trips.where("started_at < '2026-01-20'")
    source = str(tmp_path / "trips")
    trips.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(trips.schema).option("maxFilesPerTrigger", 2).parquet(source)
    out = str(tmp_path / "out")
    # A long watermark: files hold arbitrary times, nothing may count as late.
    query = (
        streaming_hourly_demand(stream, "60 days")
        .writeStream.format("memory").queryName("hourly_stream").outputMode("complete")
        .option("checkpointLocation", out).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    batch = hourly_demand(trip_events(trips))
    assert rows(spark.table("hourly_stream").select(batch.columns)) == rows(batch)


def test_stream_emits_an_hour_once_it_closed(spark, tmp_path):
    trips = Tables(spark, SF).trips.where("started_at < '2026-01-13' AND ended_at IS NOT NULL")
    source = str(tmp_path / "trips")
    for first, last in (("2026-01-01", "2026-01-07"), ("2026-01-07", "2026-01-13")):
        part = trips.where(f"started_at >= '{first}' AND started_at < '{last}'")
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(trips.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        streaming_hourly_demand(stream, "2 hours")
        .writeStream.format("memory").queryName("closed_hours").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    batch = hourly_demand(trip_events(trips))
    closed = batch.where("event_hour < '2026-01-12 20:00:00'")
    emitted = spark.table("closed_hours").select(batch.columns)
    assert set(rows(closed)) <= set(rows(emitted)) <= set(rows(batch))
    assert emitted.count() == emitted.select("station_id", "event_hour").distinct().count()


def test_forecast_reads_only_the_hours_it_needs(spark, tmp_path):
    t = Tables(spark, SF)
    path = str(tmp_path / "prices")
    t.priced.write.parquet(path)
    answers = forecast(t.forecast_requests, read_parquet(spark, path), AS_OF)
    plan = answers._jdf.queryExecution().optimizedPlan().toString() + answers._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_hour,2026-01-15T06:00" in plan
    assert "LessThanOrEqual(event_ho" in plan


def test_capacity_and_weather_files_are_joined_without_a_shuffle(spark, tmp_path):
    t = Tables(spark, SF)
    for name, table in {"trips": t.trips, "capacities": t.matches, "weather": t.weather}.items():
        table.write.parquet(str(tmp_path / name))
    trips, capacities, weather = (spark.read.parquet(str(tmp_path / n)) for n in ("trips", "capacities", "weather"))
    plan = silver_hours(trips, capacities, weather)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 3
    assert "Python" not in plan and plan.count("FileScan parquet") == 3


def test_contract(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    # The random search is checked by properties; all others have their SQL.
    assert set(registered()) - set(ORACLES) == {"param_search"}
    assert set(registered()) <= set(queries) and set(ORACLES) <= set(oracles)
    assert contract.entry(spark).count() > 0


def test_light_queries_equal_their_sql(spark):
    con = check.connect(SF)
    queries = contract.queries()
    for name in ("silver_hourly", "pricing_analysis", "price_decision", "running_stock", "station_forecast",
                 "price_requests", "spatial_capacity", "zone_summary", "sample_rows"):
        ours = queries[name](spark, SF).toPandas()
        assert check.difference(ours, con.execute(ORACLES[name]).df()) is None, name


def test_check_sees_differences(spark):
    frame = spark.range(3).withColumn("x", F.lit(1.5)).toPandas()
    other = frame.copy()
    other.loc[1, "x"] = 1.25
    assert check.difference(frame, frame.copy()) is None
    assert "1 rows" in check.difference(frame, other)
    assert "rows 3 / 2" in check.difference(frame, frame.head(2))


def test_holidays_match_the_sql():
    assert len(set(HOLIDAYS)) == 33


def test_command_line(spark, tmp_path, capsys):
    silver, table, out = str(tmp_path / "silver"), str(tmp_path / "table"), str(tmp_path / "zones")
    Tables(spark, SF).silver.write.parquet(silver)
    main(["prices", "--silver", silver, "--csv", str(tmp_path / "csv"), "--out", table])
    assert "Mild Surge" in capsys.readouterr().out
    main(["report", "--name", "zone-summary", "--prices", table, "--out", out])
    assert read_parquet(spark, out).count() == 4
    requests = str(tmp_path / "requests")
    Tables(spark, SF).price_requests.write.option("header", True).csv(requests)
    main(["answer", "--requests", requests, "--prices", table, "--out", str(tmp_path / "answers")])
    assert read_parquet(spark, str(tmp_path / "answers")).count() == 1000
