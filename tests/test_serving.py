import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import at, hours, rows
from velotide.operators.lookup import lookup_demand
from velotide.operators.skew import HOT_KEYS, hot_key_codes, left_join_hot_keys
from velotide.operators.stock import running_stock, with_default_stock
from velotide.plans.serving import TIME_ERROR, answer_requests, forecast, price_series
from velotide.schemas import FORECAST_REQUEST, PRICE_REQUEST

HISTORY = "station_id string, event_hour string, bike_demand bigint, dock_demand bigint"
SERIES = "station_id string, event_hour string, bike_demand double, dock_demand double"


def history(spark):
    return hours(
        spark,
        [
            ("1.10", "2026-01-05 08:00:00", 10, 4),
            ("1.10", "2026-01-05 08:00:00", 20, 8),
            ("2.10", "2026-01-05 08:00:00", 3, 3),
            ("2.10", "2026-01-06 09:00:00", 1, 2),
        ],
        HISTORY,
    )


def asked(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "station_id string, asked_at string")
    return df.withColumn("asked_at", F.col("asked_at").cast("timestamp_ntz"))


def test_lookup_cascade(spark):
    requests = asked(
        spark,
        ("1.10", "2026-01-05 08:59:00"),  # station and hour: mean of two rows
        ("2.10", "2026-01-07 08:00:00"),  # other day: hour of day over all stations
        ("none", "2026-01-05 09:10:00"),
        ("1.10", "2026-01-05 17:00:00"),  # no history at that hour: heuristic
        ("1.10", None),
    )
    got = lookup_demand(requests, history(spark))
    assert rows(got.select("asked_at", "predicted_bike_demand", "predicted_dock_demand")) == sorted(
        [
            (at("2026-01-05 08:59:00"), 15.0, 6.0),
            (at("2026-01-07 08:00:00"), 11.0, 5.0),
            (at("2026-01-05 09:10:00"), 1.0, 2.0),
            (at("2026-01-05 17:00:00"), 25.0, 22.5),
            (None, 10.0, 9.0),
        ],
        key=repr,
    )


def test_lookup_without_history(spark):
    nothing = history(spark).where("false")
    got = lookup_demand(asked(spark, ("1.10", "2026-01-04 18:00:00")), nothing).first()
    assert (got.predicted_bike_demand, got.predicted_dock_demand) == (15.0, 13.5)


def test_hot_key_join_equals_plain_join(spark):
    generator = random.Random(1)
    keys = ["hot"] * 9000 + [None] * 1500 + [f"k{generator.randrange(6000)}" for _ in range(9000)]
    left = spark.createDataFrame([(i, k, 8) for i, k in enumerate(keys)], "n int, k string, h int").repartition(6)
    table = spark.createDataFrame([("hot", 8, 1.0)] + [(f"k{i}", 8, float(i)) for i in range(0, 6000, 2)], "k string, h int, v double")
    plain = rows(left.join(table, ["k", "h"], "left"))
    codes = hot_key_codes(left, ["k", "h"])
    hot = left.where("k = 'hot'").select(F.xxhash64("k", "h")).first()[0]
    assert hot in codes and len(codes) <= HOT_KEYS
    assert rows(left_join_hot_keys(left, table, ["k", "h"]).select("k", "h", "n", "v")) == plain
    nothing = left.where("false")
    assert hot_key_codes(nothing, ["k"]) == []
    assert left_join_hot_keys(nothing, table, ["k", "h"]).count() == 0


def test_price_requests_keep_refused_ones(spark):
    requests = spark.createDataFrame(
        [
            (1, "1.10", "2026-01-05 08:00", False, 10, 10, 50),
            (2, "1.10", "05/01/2026 8am", False, 10, 10, 50),
            (3, "1.10", None, False, 10, 10, 50),
        ],
        PRICE_REQUEST,
    )
    good, bad, missing = answer_requests(requests, history(spark)).orderBy("request_id").collect()
    assert (good.predicted_bike_demand, good.pricing_zone, good.pricing_multiplier, good.error) == (15.0, "Surge", 1.3, None)
    for refused in (bad, missing):
        assert refused.error == TIME_ERROR
        assert refused.pricing_multiplier is None and refused.reason is None and refused.predicted_bike_demand is None


def plain_walk(series, capacity, bikes, docks):
    """Stock before each hour, one hour after the other."""
    out = []
    for bike_demand, dock_demand in series:
        out.append((bikes, docks))
        bikes = min(capacity, max(0, bikes - int(bike_demand) + int(dock_demand)))
        docks = capacity - bikes
    return out


def test_running_stock_by_hand(spark):
    demands = [(30.9, 1.2), (5.0, 7.9), (0.0, 60.0), (3.0, 3.0)]
    df = hours(spark, [("1.10", f"2026-01-05 0{h}:00:00", *d) for h, d in enumerate(demands)], SERIES)
    df = df.withColumn("start_bikes", F.lit(20)).withColumn("start_docks", F.lit(7))
    got = running_stock(with_default_stock(df, 50)).orderBy("event_hour").collect()
    assert [r.available_bikes for r in got] == [20, 0, 2, 50]
    # The first hour uses the docks that were given, later ones what is free.
    assert [r.available_docks for r in got] == [7, 50, 48, 0]


def test_hours_are_shuffled_once(spark, tmp_path):
    table = [(f"s{i % 5}", f"2026-01-{1 + i % 28:02d} 0{i % 10}:00:00", 1.0 * (i % 7), 2.0) for i in range(140)]
    hours(spark, table, SERIES).write.parquet(str(tmp_path / "hours"))
    stock = running_stock(with_default_stock(spark.read.parquet(str(tmp_path / "hours"))))
    assert len(stock.collect()) == 140
    plan = stock._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_default_stock_is_half_the_capacity(spark):
    df = hours(spark, [("1.10", "2026-01-05 00:00:00", 1.0, 1.0)], SERIES)
    row = running_stock(with_default_stock(df, 51)).first()
    assert (row.capacity, row.available_bikes, row.available_docks) == (51, 25, 26)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_running_stock_over_weeks_equals_the_plain_walk(spark, seed):
    generator = random.Random(seed)
    table, expected = [], {}
    for station in range(4):
        capacity = generator.choice([3, 10, 25])
        bikes, docks = generator.randrange(0, capacity + 5), generator.randrange(0, 9)
        series = [(generator.uniform(0, 8), generator.uniform(0, 8)) for _ in range(24 * 23)]
        # Hours without a row occur, and stations start at different times.
        times = sorted(generator.sample(range(24 * 60), len(series)))
        for hour, demand in zip(times, series, strict=True):
            stamp = f"2026-{1 + hour // 24 // 28:02d}-{1 + hour // 24 % 28:02d} {hour % 24:02d}:00:00"
            table.append((f"s{station}", stamp, *demand, capacity, bikes, docks))
        expected[f"s{station}"] = plain_walk(series, capacity, bikes, docks)
    df = hours(spark, table, SERIES + ", capacity int, start_bikes int, start_docks int")
    got = {}
    for row in running_stock(with_default_stock(df.repartition(5))).orderBy("station_id", "event_hour").collect():
        got.setdefault(row.station_id, []).append((row.available_bikes, row.available_docks))
        assert row.available_bikes <= max(row.capacity, row.available_bikes if len(got[row.station_id]) == 1 else 0)
    assert got == expected


def test_series_of_a_day(spark):
    table = [("1.10", f"2026-06-15 {h:02d}:00:00", 10.0, 8.0) for h in range(24)]
    df = hours(spark, table, SERIES).withColumn("start_bikes", F.lit(15)).withColumn("start_docks", F.lit(35))
    got = price_series(df).orderBy("timestamp").collect()
    assert len(got) == 24
    assert [r.available_bikes_now for r in got] == [max(0, 15 - 2 * h) for h in range(24)]
    assert got[0].available_docks_now == 35 and got[0].timestamp == "2026-06-15 00:00"
    assert all(round(4.49 * r.pricing_multiplier, 2) == r.suggested_price_usd for r in got)


def test_forecast_of_24_hours(spark):
    requests = spark.createDataFrame([(7, "1.10", 50, 15, 15), (8, "9.10", 20, 0, 20)], FORECAST_REQUEST)
    got = forecast(requests, history(spark), "2026-01-05 08:45:00").orderBy("request_id", "timestamp").collect()
    assert len(got) == 48
    first, second = got[0], got[1]
    assert (first.timestamp, first.predicted_bike_demand, first.pricing_zone) == ("2026-01-05 08:00", 15.0, "Normal")
    # 09:00 falls back to the hour of day; 15 - 15 + 6 bikes are left.
    assert (second.timestamp, second.predicted_bike_demand, second.predicted_dock_demand) == ("2026-01-05 09:00", 1.0, 2.0)
    assert second.pricing_multiplier == 0.79
    assert got[23].timestamp == "2026-01-06 07:00"
