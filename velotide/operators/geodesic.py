"""Nearest feed station by great-circle distance, anywhere on the globe.

Latitudes are cut into bands a little higher than the radius.  Each band has
as many cells around the globe as keep a cell wider than the radius reaches
there, so cells widen towards the poles, and the last bands have a single one.  What lies within the
radius of a station is then in its own or an adjacent cell of its own or an
adjacent band; cells are counted around the globe, so the date line is no edge.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.geo import EARTH_RADIUS_M, haversine_m
from velotide.operators.spatial import feed_positions

# Room for rounding: bands and cells are so much larger than the radius.
_MARGIN = 1.0001


class Grid:
    """Bands and cells for one radius; ``radius_m`` is above 0 and at most a twelfth of the globe."""

    def __init__(self, radius_m: float):
        if not 0 < radius_m <= EARTH_RADIUS_M * math.pi / 6:
            raise ValueError(f"radius out of range: {radius_m}")
        self.reach = radius_m / EARTH_RADIUS_M
        self.height = math.degrees(self.reach) * _MARGIN

    def band(self, lat: Column) -> Column:
        return F.floor(lat / self.height)

    def cells(self, band: Column) -> Column:
        """Cells around the globe in a band: as wide at least as the reach of a station in an adjacent one.

        From latitude t a circle of angular radius s reaches asin(sin s / cos t)
        degrees of longitude to either side, and all around once it holds a pole.
        """
        farthest = F.greatest(F.abs(band - 1), F.abs(band + 2)) * self.height
        ratio = math.sin(self.reach) / F.cos(F.radians(farthest))
        width = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * _MARGIN
        open_sky = farthest < 90.0 - self.height
        return F.when(open_sky, F.greatest(F.floor(360.0 / width), F.lit(1))).otherwise(F.lit(1)).cast("long")

    def cell(self, lng: Column, cells: Column) -> Column:
        """Number of the cell around the globe; 180 and -180 degrees are one place."""
        turned = F.pmod(lng + 180.0, F.lit(360.0))
        return F.least(F.floor(turned * cells / 360.0), cells - 1).cast("long")


def _around(places: DataFrame, grid: Grid, lat: str, lng: str) -> DataFrame:
    """``places`` once for every cell that may hold something within the radius."""
    near = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    in_bands = places.withColumn("band", F.explode(F.transform(near, lambda i: grid.band(F.col(lat)) + i)))
    in_bands = in_bands.withColumn("cells", grid.cells(F.col("band")))
    own = grid.cell(F.col(lng), F.col("cells"))
    beside = F.array_distinct(F.transform(near, lambda i: F.pmod(own + i, F.col("cells"))))
    return in_bands.withColumn("cell", F.explode(beside)).drop("cells")


def _on_globe(df: DataFrame, lat: str, lng: str) -> DataFrame:
    return df.where(F.col(lat).between(-90.0, 90.0) & (F.abs(lng) < float("inf")) & ~F.isnan(lng))


def match_by_great_circle(stations: DataFrame, feed: DataFrame, max_distance_m: float = 100.0) -> DataFrame:
    """station_id, capacity (0 without a match), matched, metres of the nearest feed station within the radius.

    Ranked by great-circle distance, ties by the lowest feed id; no test in
    plain degrees.  Rows without a usable position match nothing.  Both sides are reduced to
    distinct positions; a pair of them is formed once, in the join, and only the
    nearest one of each task and station is shuffled.
    """
    grid = Grid(max_distance_m)
    positions = _on_globe(feed_positions(feed), "lat", "lon").withColumn("band", grid.band(F.col("lat")))
    positions = positions.withColumn("cell", grid.cell(F.col("lon"), grid.cells(F.col("band"))))
    places = _on_globe(stations, "latitude", "longitude").select("latitude", "longitude").distinct()
    here = [F.col(c) for c in ("latitude", "longitude", "lat", "lon")]
    pairs = _around(places, grid, "latitude", "longitude").join(positions, ["band", "cell"])
    within = pairs.withColumn("metres", haversine_m(*here)).where(F.col("metres") <= max_distance_m)
    nearest = within.groupBy("latitude", "longitude").agg(F.min(F.struct("metres", "feed_id", "capacity")).alias("hit"))
    hits = nearest.select("latitude", "longitude", F.col("hit.metres").alias("metres"), F.col("hit.capacity").alias("capacity"))
    found = stations.select("station_id", "latitude", "longitude").join(hits, ["latitude", "longitude"], "left")
    return found.select(
        "station_id", F.coalesce("capacity", F.lit(0)).cast("int").alias("capacity"),
        F.col("metres").isNotNull().alias("matched"), "metres",
    )
