"""Capacity of the nearest feed station within a radius.

For each station: take the feed station nearest by plain degree distance, then
reject it when farther than ``radius / 111000`` degrees or when the great-circle
distance exceeds the radius.  Ties go to the lowest feed id.

The join is an equi-join on grid cells.  Copies cost nothing: both sides are
reduced to distinct positions first.  Where many distinct feed positions crowd
one cell, the feed is searched through nested finer cells, and cells that cannot
hold the nearest position are discarded, so work per station does not grow with
the number of positions in a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.functions.geo import METRES_PER_DEGREE, degree_distance, haversine_m

# Cells are a little larger than the radius, so that rounding in the division
# cannot put a position in reach two cells away.
_MARGIN = 1.0001
# Finer cells per cell and axis, and how deep they may nest.
_FANOUT = 4
_MAX_DEPTH = 8
# Distinct feed positions a leaf cell may hold before it is divided further.
CROWDED_CELL = 64


def _cell(coordinate: str | Column, size: float) -> Column:
    column = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    return F.floor(column / size)


def feed_positions(feed: DataFrame) -> DataFrame:
    """Distinct positions; of feed stations at one place the lowest id answers."""
    return (
        feed.where("lat IS NOT NULL AND lon IS NOT NULL")
        .groupBy("lat", "lon")
        .agg(F.min(F.struct("feed_id", "capacity")).alias("owner"))
        .select("lat", "lon", "owner.feed_id", "owner.capacity")
    )


def search_depth(positions: DataFrame, cell: float, crowded: int = CROWDED_CELL) -> int:
    """How often cells must be divided until none is crowded.

    An action on the feed only (one small aggregate per level); a feed without
    crowded cells costs one.
    """
    for depth in range(_MAX_DEPTH + 1):
        size = cell / _FANOUT**depth
        fullest = (
            positions.groupBy(_cell("lat", size).alias("r"), _cell("lon", size).alias("c"))
            .count()
            .agg(F.max("count"))
            .first()[0]
        )
        if fullest is None or fullest <= crowded:
            return depth
    return _MAX_DEPTH


def _neighbour_cells(positions: DataFrame, cell: float) -> DataFrame:
    """Every position's cell listed under the nine cells around it."""
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    return (
        positions.withColumns({"r0": _cell("lat", cell), "c0": _cell("lon", cell)})
        .withColumn("dr", F.explode(around))
        .withColumn("dc", F.explode(around))
        .withColumns({"near_r": F.col("r0") + F.col("dr"), "near_c": F.col("c0") + F.col("dc")})
        .drop("dr", "dc")
    )


def _box_bounds(r: Column, c: Column, size: float) -> tuple[Column, Column]:
    """Smallest and largest degree distance from a station to a cell's box."""
    lat, lng = F.col("latitude"), F.col("longitude")
    south, west = r * size, c * size
    north, east = south + size, west + size
    gap_lat = F.greatest(south - lat, lat - north, F.lit(0.0))
    gap_lng = F.greatest(west - lng, lng - east, F.lit(0.0))
    far_lat = F.greatest(F.abs(lat - south), F.abs(lat - north))
    far_lng = F.greatest(F.abs(lng - west), F.abs(lng - east))
    nearest = F.sqrt(gap_lat * gap_lat + gap_lng * gap_lng)
    farthest = F.sqrt(far_lat * far_lat + far_lng * far_lng)
    return nearest, farthest


def _candidates(
    stations: DataFrame, positions: DataFrame, cell: float, depth: int, limit_deg: float
) -> DataFrame:
    """(station position, feed position) pairs that can be the nearest."""
    keyed = stations.withColumns({"near_r": _cell("latitude", cell), "near_c": _cell("longitude", cell)})
    if depth == 0:
        return keyed.join(_neighbour_cells(positions, cell), ["near_r", "near_c"])

    sizes = [cell / _FANOUT**level for level in range(depth + 1)]
    coded = positions
    for level, size in enumerate(sizes):
        coded = coded.withColumns({f"r{level}": _cell("lat", size), f"c{level}": _cell("lon", size)})

    reach = keyed.join(
        _neighbour_cells(positions, cell).select("near_r", "near_c", "r0", "c0").distinct(),
        ["near_r", "near_c"],
    ).select("latitude", "longitude", "r0", "c0")
    here = Window.partitionBy("latitude", "longitude")
    for level in range(1, depth + 1):
        parent, child = [f"r{level - 1}", f"c{level - 1}"], [f"r{level}", f"c{level}"]
        nearest, farthest = _box_bounds(F.col(child[0]), F.col(child[1]), sizes[level])
        slack = limit_deg * 1e-6
        reach = (
            reach.join(coded.select(*parent, *child).distinct(), parent)
            .withColumns({"_near": nearest, "_far": farthest})
            .withColumn("_best", F.min("_far").over(here))
            .where(F.col("_near") <= F.least(F.col("_best"), F.lit(limit_deg)) + slack)
            .select("latitude", "longitude", *child)
        )
    leaf = [f"r{depth}", f"c{depth}"]
    return reach.join(coded.select(*leaf, "lat", "lon", "feed_id", "capacity"), leaf)


def match_stations(
    stations: DataFrame,
    feed: DataFrame,
    max_distance_m: float = 100.0,
    crowded: int = CROWDED_CELL,
) -> DataFrame:
    """station_id, capacity (0 without a match), matched."""
    limit_deg = max_distance_m / METRES_PER_DEGREE
    cell = limit_deg * _MARGIN
    positions = feed_positions(feed)
    located = stations.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    places = located.select("latitude", "longitude").distinct()

    depth = search_depth(positions, cell, crowded)
    pairs = _candidates(places, positions, cell, depth, limit_deg)
    here = (F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    nearest = (
        pairs.withColumn("degrees", degree_distance(*here))
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct("degrees", "feed_id", "capacity", "lat", "lon")).alias("hit"))
        .select("latitude", "longitude", "hit.*")
    )
    accepted = nearest.where(
        (F.col("degrees") <= limit_deg) & (haversine_m(*here) <= max_distance_m)
    ).select("latitude", "longitude", "capacity", F.lit(True).alias("matched"))
    return (
        stations.select("station_id", "latitude", "longitude")
        .join(accepted, ["latitude", "longitude"], "left")
        .select(
            "station_id",
            F.coalesce("capacity", F.lit(0)).cast("int").alias("capacity"),
            F.coalesce("matched", F.lit(False)).alias("matched"),
        )
    )


def match_coverage(matches: DataFrame) -> DataFrame:
    """Stations, matched stations and stations of non-zero capacity."""
    return matches.agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if("matched").alias("stations_matched"),
        F.count_if(F.col("capacity") > 0).alias("stations_with_capacity"),
    )
