from datetime import date

from tests.helpers import at, hours, rows
from velotide.operators.enrich import join_coverage, with_capacity, with_holiday, with_weather
from velotide.sources.holidays import holidays

HOURS = "station_id string, event_hour string"


def test_holidays_are_by_calendar_date(spark):
    df = hours(spark, [("a", "2026-07-04 23:00:00"), ("a", "2026-07-03 23:00:00"), ("a", "2026-01-19 00:00:00")], HOURS)
    got = {r.event_hour: r.is_holiday for r in with_holiday(df).collect()}
    assert got == {at("2026-07-04 23:00:00"): 1, at("2026-07-03 23:00:00"): 0, at("2026-01-19 00:00:00"): 1}
    assert holidays(spark).count() == 33


def test_weather_and_capacity_keep_all_rows(spark):
    df = hours(spark, [("a", "2026-01-05 23:00:00"), ("b", "2026-01-06 00:00:00")], HOURS)
    weather = spark.createDataFrame([(date(2026, 1, 5), 1.5, 0.0, 9.0)], "date date, temp_c double, precip_mm double, wind_kmh double")
    capacities = spark.createDataFrame([("b", 12)], "station_id string, capacity int")
    got = with_capacity(with_weather(df, weather), capacities)
    assert rows(got.select("station_id", "temp_c", "capacity")) == [("a", 1.5, 0), ("b", None, 12)]
    assert tuple(join_coverage(got).first()) == (2, 1, 1, 1)
    assert with_weather(df, None) is df
