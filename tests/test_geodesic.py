"""Great-circle matching against the distance of every pair."""

from __future__ import annotations

import math
import random

import pytest

from velotide.operators.geodesic import match_by_great_circle

FEED = "feed_id string, name string, lat double, lon double, capacity int"


def metres(a, b):
    (t1, g1), (t2, g2) = (tuple(map(math.radians, p)) for p in (a, b))
    h = math.sin((t2 - t1) / 2) ** 2 + math.cos(t1) * math.cos(t2) * math.sin((g2 - g1) / 2) ** 2
    return math.asin(math.sqrt(h)) * 2 * 6_371_000


def matched(spark, stations, feed, radius):
    s = spark.createDataFrame([(str(i), *p) for i, p in enumerate(stations)], "station_id string, latitude double, longitude double")
    f = spark.createDataFrame([(f"{i:04}", "n", *p, i + 1) for i, p in enumerate(feed)], FEED)
    return {int(r.station_id): (r.capacity, r.matched) for r in match_by_great_circle(s, f, radius).collect()}


def brute(stations, feed, radius):
    found = {}
    for i, p in enumerate(stations):
        near = [(metres(p, q), j) for j, q in enumerate(feed) if metres(p, q) <= radius]
        found[i] = (min(near)[1] + 1, True) if near else (0, False)
    return found


@pytest.mark.parametrize("radius", [100.0, 40_000.0, 900_000.0])
def test_equals_all_pairs_all_over_the_globe(spark, radius):
    generator = random.Random(int(radius))
    places = [(90.0, 0.0), (-90.0, 77.0), (0.0, 180.0), (0.0, -180.0), (59.99, 179.9999), (89.9999, -170.0)]
    places += [(math.degrees(math.asin(generator.uniform(-1, 1))), generator.uniform(-180, 180)) for _ in range(150)]
    places += [(generator.choice([-1, 1]) * generator.uniform(88, 90), generator.uniform(-180, 180)) for _ in range(60)]
    places += [(generator.uniform(-80, 80), generator.choice([-1, 1]) * generator.uniform(179.99, 180)) for _ in range(60)]
    feed = []
    for lat, lng in places:
        # A neighbour at about the radius in any direction, across the pole or the date line too.
        step = math.degrees(radius / 6_371_000) * generator.uniform(0.05, 1.4)
        turn = generator.uniform(0, 2 * math.pi)
        t, g = math.radians(lat), math.radians(lng)
        t2 = math.asin(math.sin(t) * math.cos(math.radians(step)) + math.cos(t) * math.sin(math.radians(step)) * math.cos(turn))
        g2 = g + math.atan2(math.sin(turn) * math.sin(math.radians(step)) * math.cos(t), math.cos(math.radians(step)) - math.sin(t) * math.sin(t2))
        feed.append((math.degrees(t2), (math.degrees(g2) + 180) % 360 - 180))
    want = brute(places, feed, radius)
    assert matched(spark, places, feed, radius) == want and 0 < sum(m for _, m in want.values())


def test_ties_repeats_and_unusable_positions(spark):
    stations = [(10.0, 20.0), (None, 20.0), (91.0, 0.0), (10.0, float("nan")), (10.0, 20.0)]
    feed = [(10.0, 20.0005), (10.0, 19.9995), (10.0, 20.0005), (None, 1.0), (95.0, 20.0)]
    assert matched(spark, stations, feed, 100.0) == {0: (1, True), 4: (1, True), 1: (0, False), 2: (0, False), 3: (0, False)}
    assert matched(spark, stations[:1], [], 100.0) == {0: (0, False)} and matched(spark, [], feed, 100.0) == {}
    with pytest.raises(ValueError):
        match_by_great_circle(spark.range(1), spark.range(1), 0)


def test_eastern_neighbours_the_degree_rule_refuses(spark):
    """At 60 degrees, 90 metres east are 0.0016 degrees: beyond 100 / 111000."""
    assert matched(spark, [(60.0, 10.0)], [(60.0, 10.0016)], 100.0) == {0: (1, True)}
