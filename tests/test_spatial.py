import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import rows
from velotide.functions.geo import METRES_PER_DEGREE
from velotide.operators.spatial import feed_positions, match_coverage, match_stations, search_depth

STATIONS = "station_id string, latitude double, longitude double"
FEED = "feed_id string, lat double, lon double, capacity int"


def metres(lat1, lng1, lat2, lng2):
    dlat, dlng = math.radians(lat2 - lat1), math.radians(lng2 - lng1)
    a = math.sin(dlat / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlng / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(a))


def brute_force(stations, feed, radius):
    result = []
    for sid, lat, lng in stations:
        best = None
        if lat is not None and lng is not None and feed:
            best = min(feed, key=lambda f: (math.sqrt((f[1] - lat) ** 2 + (f[2] - lng) ** 2), f[0]))
            degrees = math.sqrt((best[1] - lat) ** 2 + (best[2] - lng) ** 2)
            if degrees > radius / METRES_PER_DEGREE or metres(lat, lng, best[1], best[2]) > radius:
                best = None
        result.append((sid, best[3] if best else 0, best is not None))
    return sorted(result, key=repr)


def frames(spark, stations, feed):
    return spark.createDataFrame(stations, STATIONS), spark.createDataFrame(feed, FEED)


def test_exact_hits_and_far_station(spark):
    stations = [("s1", 40.73, -73.99), ("s2", 40.75, -73.95), ("far_station", 34.05, -118.24), ("lost", None, -73.9)]
    feed = [("f1", 40.73, -73.99, 42), ("f2", 40.75, -73.95, 30)]
    got = match_stations(*frames(spark, stations, feed), max_distance_m=200.0)
    assert rows(got.select("station_id", "capacity")) == [("far_station", 0), ("lost", 0), ("s1", 42), ("s2", 30)]
    assert tuple(match_coverage(got).first()) == (4, 2, 2)


def test_both_distance_tests_apply(spark):
    # 0.00095 degrees east is about 80 m, yet beyond 100 m / 111000 degrees.
    stations = [("north", 40.70, -74.0), ("east", 40.80, -74.0), ("tie", 40.90, -74.0)]
    feed = [("a", 40.7005, -74.0, 7), ("b", 40.80, -73.99905, 8), ("y", 40.90, -74.0, 5), ("x", 40.90, -74.0, 6)]
    assert metres(40.80, -74.0, 40.80, -73.99905) < 100
    got = match_stations(*frames(spark, stations, feed))
    assert rows(got) == [("east", 0, False), ("north", 7, True), ("tie", 6, True)]


def test_nearest_is_chosen_before_it_is_rejected(spark):
    # The nearest by degrees fails the test although another one is in reach in metres.
    stations = [("s", 60.0, 0.0)]
    feed = [("a", 60.0, 0.0012, 3), ("b", 60.00125, 0.0, 4)]
    assert rows(match_stations(*frames(spark, stations, feed), max_distance_m=100.0)) == [("s", 0, False)]


def test_empty_feed(spark):
    stations, feed = frames(spark, [("s", 1.0, 1.0)], [("f", None, None, 1)])
    assert rows(match_stations(stations, feed)) == [("s", 0, False)]


points = st.tuples(st.integers(0, 60), st.integers(0, 60))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(points, min_size=1, max_size=40), st.lists(points, min_size=1, max_size=40), st.sampled_from([1, 3, 64]))
def test_equals_brute_force(spark, left, right, crowded):
    step = 0.00021
    stations = [(f"s{i}", 40.7 + a * step, -74.0 + b * step) for i, (a, b) in enumerate(left)]
    feed = [(f"f{i:03d}", 40.7 + a * step, -74.0 + b * step, i % 9) for i, (a, b) in enumerate(right)]
    got = match_stations(*frames(spark, stations, feed), crowded=crowded)
    assert rows(got) == brute_force(stations, feed, 100.0)


@pytest.fixture(scope="module")
def crowd():
    """A third of all positions, and many copies of one, within a few metres."""
    stations = [(f"s{i}", 40.7 + (i % 37) * 2.3e-6, -74.0 + (i // 37) * 1.7e-6) for i in range(700)]
    stations += [(f"c{i}", 40.7, -74.0) for i in range(300)]
    stations += [(f"w{i}", 40.7 + i * 3.1e-4, -74.0 - i * 2.9e-4) for i in range(200)]
    feed = [(f"f{i:04d}", 40.7003 + (i % 29) * 1.9e-6, -74.0 + (i // 29) * 2.1e-6, i % 50) for i in range(700)]
    feed += [(f"g{i:04d}", 40.7 + i * 3.3e-4, -74.0 - i * 2.8e-4, i % 11) for i in range(200)]
    feed += [(f"h{i:04d}", 40.7003, -74.0, 1) for i in range(200)]
    return stations, feed


def test_crowded_cells_are_divided_and_stay_exact(spark, crowd):
    stations, feed = frames(spark, *crowd)
    cell = 100 / METRES_PER_DEGREE
    assert search_depth(feed_positions(feed), cell) > 0
    assert rows(match_stations(stations, feed)) == brute_force(*crowd, 100.0)
