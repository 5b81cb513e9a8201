import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import at
from velotide.functions import pricing as rule
from velotide.functions.calendar import (
    calendar_columns,
    cyclic_columns,
    duration_seconds,
    hour_of,
    parse_time,
)
from velotide.functions.geo import haversine_m
from velotide.functions.rounding import exact_round, scaled_round, whole
from velotide.operators.pricing import decide_prices, price_station_hours, with_stock_estimate


@pytest.mark.parametrize("digits", [1, 2])
def test_exact_round_equals_scalar_rounding(spark, digits):
    generator = random.Random(7)
    values = [1.115, 2.675, 0.925, 1.005, 0.125, 0.375, 1.195, -1.115, -0.125, 0.0, 6.735, 5.837, 12.5, 0.25, 0.35]
    values += [generator.randrange(400_000) / 2000 for _ in range(4000)]
    values += [generator.uniform(-50, 50) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", exact_round(F.col("x"), digits).alias("r")).collect()
    assert [(x, r) for x, r in got if r != round(x, digits)] == []


def test_scaled_round_and_whole(spark):
    df = spark.createDataFrame([(1.115,), (0.125,), (2.5,), (3.5,), (-2.5,)], "x double")
    got = df.select(scaled_round(F.col("x"), 2), whole(F.col("x"))).collect()
    assert [r[0] for r in got] == [1.12, 0.12, 2.5, 3.5, -2.5]
    assert [r[1] for r in got] == [1, 0, 2, 4, -2]


def test_parse_time_is_null_for_other_formats(spark):
    texts = ["2026-01-05 08:10:11.250", "2026-01-05 08:10:11", "2026-01-05", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_time(F.col("t"))).collect()]
    assert got == [at("2026-01-05 08:10:11.250"), None, None, None, None]


def test_calendar(spark):
    df = spark.createDataFrame([("2026-01-04 09:59:59",), ("2025-12-29 17:00:00",), ("2026-01-03 20:30:00",)], "t string")
    ts = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = ts.select(hour_of(F.col("t")).alias("h"), *[c.alias(n) for n, c in calendar_columns(F.col("t")).items()]).collect()
    sunday, monday, saturday = got
    assert sunday.h == at("2026-01-04 09:00:00")
    assert (sunday.weekday, sunday.is_weekend, sunday.is_rush_hour, sunday.dayofyear) == (1, 1, 1, 4)
    # ISO week: the last days of December can belong to week 1.
    assert (monday.weekday, monday.weekofyear, monday.is_weekend, monday.is_rush_hour) == (2, 1, 0, 1)
    assert (saturday.weekday, saturday.is_weekend, saturday.is_rush_hour) == (7, 1, 0)


def test_cycles_return_to_start(spark):
    df = spark.createDataFrame([(0,), (6,), (12,), (24,)], "hour int")
    got = df.select(*[c.alias(n) for n, c in cyclic_columns("hour", 24).items()]).collect()
    assert [(round(r.hour_sin, 9) + 0.0, round(r.hour_cos, 9) + 0.0) for r in got] == [(0, 1), (1, 0), (0, -1), (0, 1)]


def test_duration_counts_whole_epoch_seconds(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:00.900", "2026-01-01 00:00:02.100"),
                                ("2026-01-01 00:10:00", "2026-01-01 00:00:00")], "a string, b string")
    a, b = (F.col(c).cast("timestamp_ntz") for c in "ab")
    assert [r[0] for r in df.select(duration_seconds(a, b)).collect()] == [2.0, -600.0]


def test_haversine(spark):
    df = spark.createDataFrame([(40.7580, -73.9855, 40.7580, -73.9855), (40.7580, -73.9855, 40.7527, -73.9772)],
                               "a double, b double, c double, d double")
    same, apart = (r[0] for r in df.select(haversine_m(*[F.col(c) for c in "abcd"])).collect())
    assert same == 0 and 800 < apart < 1500


# bike demand, dock demand, bikes, docks -> decision (multiplier, price, zone), analysis (multiplier, zone)
GOLDEN = [
    ((35, 10, 10, 15), (1.50, 6.74, "Surge"), (1.50, "Surge")),
    ((10, 40, 20, 5), (1.30, 5.84, "Mild Surge"), (1.30, "Surge")),
    ((10, 10, 20, 20), (1.00, 4.49, "Normal"), (1.00, "Normal")),
    ((1, 1, 30, 25), (0.76, 3.41, "Discount"), (0.76, "Discount")),
    ((50, 60, 3, 2), (2.00, 8.98, "Surge"), (2.00, "Surge")),
    ((5, 3, 0, 10), (1.50, 6.74, "Surge"), (1.50, "Surge")),
    ((35, 10, 5, 15), (1.50, 6.74, "Surge"), (1.50, "Surge")),
    ((5, 5, 25, 25), (0.80, 3.59, "Discount"), (0.80, "Discount")),
    ((13.1, 10, 10, 20), (1.19, 5.34, "Surge"), (1.19, "Mild Surge")),
    ((4, 18, 10, 20), (0.91, 4.09, "Discount"), (0.91, "Normal")),
    ((16, 16, 10, 10), (1.72, 7.72, "Surge"), (1.90, "Surge")),
    # Exactly on a threshold is outside it: -0.5/-0.5, -0.3, 0.5.
    ((15, 15, 10, 10), (1.30, 5.84, "Surge"), (1.30, "Surge")),
    ((13, 13, 10, 10), (1.00, 4.49, "Normal"), (1.00, "Normal")),
    ((5, 5, 10, 10), (1.00, 4.49, "Normal"), (1.00, "Normal")),
]


def priced(spark, inputs):
    table = [(i, float(p), float(q), b, d) for i, (p, q, b, d) in enumerate(inputs)]
    return spark.createDataFrame(
        table,
        "n int, predicted_bike_demand double, predicted_dock_demand double, available_bikes int, available_docks int",
    )


def test_golden_prices(spark):
    df = priced(spark, [g[0] for g in GOLDEN])
    decided = decide_prices(df).orderBy("n").collect()
    assert [(r.pricing_multiplier, r.suggested_price_usd, r.pricing_zone) for r in decided] == [g[1] for g in GOLDEN]
    b = rule.gap_ratio(F.col("available_bikes") - F.col("predicted_bike_demand"), F.col("available_bikes"))
    d = rule.gap_ratio(F.col("available_docks") - F.col("predicted_dock_demand"), F.col("available_docks"))
    m = rule.analysis_multiplier(b, d)
    analysed = df.orderBy("n").select(m, rule.analysis_zone(m)).collect()
    assert [tuple(r) for r in analysed] == [g[2] for g in GOLDEN]


def test_reasons_name_the_gap(spark):
    df = priced(spark, [(50, 60, 3, 2), (35, 10, 10, 15), (10, 40, 20, 5), (1, 1, 30, 25), (5, 18, 20, 20), (10, 10, 20, 20)])
    reasons = [r.reason for r in decide_prices(df).orderBy("n").collect()]
    assert reasons == [
        "Double shortage: bikes 47 short, docks 58 short. Heavy surge applied.",
        "Bike shortage: predicted demand exceeds supply by 25. Surge applied to encourage nearby station use.",
        "Dock congestion: predicted returns exceed empty docks by 35. Mild surge to discourage returns here.",
        "Double surplus: bikes and docks both abundant. Discount applied to attract riders.",
        "Bike surplus: 15 extra bikes. Mild discount to encourage use.",
        "Supply and demand balanced. Standard pricing.",
    ]


def test_decision_rounds_after_deciding(spark):
    row = decide_prices(priced(spark, [(13.04, 9.25, 10, 20)])).first()
    assert (row.predicted_bike_demand, row.predicted_dock_demand) == (13.0, 9.2)
    assert (row.bike_gap, row.dock_gap, row.pricing_multiplier) == (-3, 11, 1.18)


def reference_multiplier(b, d, both):
    """The published rule, in plain Python."""
    if b < -0.5 and d < -0.5:
        m = min(both(b, d), 2.0)
    elif b < -0.3:
        m = min(1.0 + abs(b) * 0.6, 1.5)
    elif d < -0.3:
        m = min(1.0 + abs(d) * 0.4, 1.3)
    elif b > 0.5 and d > 0.5:
        m = max(1.0 - min(b, d) * 0.25, 0.7)
    elif b > 0.5:
        m = max(1.0 - b * 0.15, 0.8)
    else:
        m = 1.0
    return round(m, 2)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90), st.integers(0, 40), st.integers(0, 40)), min_size=50, max_size=200))
def test_multiplier_matches_plain_python_and_its_bounds(spark, inputs):
    df = priced(spark, inputs)
    b = rule.gap_ratio(F.col("available_bikes") - F.col("predicted_bike_demand"), F.col("available_bikes"))
    d = rule.gap_ratio(F.col("available_docks") - F.col("predicted_dock_demand"), F.col("available_docks"))
    got = df.orderBy("n").select(rule.analysis_multiplier(b, d), rule.decision_multiplier(b, d)).collect()
    for (p, q, bikes, docks), (analysis, decision) in zip(inputs, got, strict=True):
        x, y = (bikes - p) / max(bikes, 1), (docks - q) / max(docks, 1)
        assert analysis == reference_multiplier(x, y, lambda b, d: 1.3 + (abs(b) + abs(d)) * 0.5)
        assert decision == reference_multiplier(x, y, lambda b, d: 1.3 + abs(b + d) / 2 * 0.7)
        assert 0.7 <= analysis <= 2.0 and 0.7 <= decision <= 2.0


def test_stock_estimate(spark):
    df = spark.createDataFrame([(50,), (51,), (100,), (0,), (-3,), (1,), (2,)], "capacity int")
    got = [tuple(r) for r in with_stock_estimate(df).collect()]
    assert got == [(50, 25, 25), (51, 25, 26), (100, 50, 50), (0, 15, 15), (-3, 15, 15), (1, 1, 1), (2, 1, 1)]


def test_pricing_table_has_no_shuffle(spark):
    silver = spark.createDataFrame(
        [("1.10", at("2026-01-05 08:00:00"), 3, 4, 6)],
        "station_id string, event_hour timestamp_ntz, bike_demand bigint, dock_demand bigint, capacity int",
    )
    table = price_station_hours(silver)
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    row = table.first()
    assert (row.available_bikes, row.bike_gap, row.dock_gap) == (3, 0, -1)


def test_heuristic_demand(spark):
    df = spark.createDataFrame([("2026-01-05 08:30:00",), ("2026-01-05 12:00:00",), ("2026-01-04 18:00:00",), ("2026-01-04 03:00:00",)], "t string")
    got = df.select(*rule.heuristic_demand(F.col("t").cast("timestamp_ntz"))).collect()
    assert [tuple(r) for r in got] == [(25.0, 22.5), (10.0, 9.0), (15.0, 13.5), (6.0, 5.4)]
