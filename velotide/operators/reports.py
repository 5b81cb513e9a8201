"""Reports over the priced station-hours.

Means of prices and multipliers are taken over whole cents, so they do not
depend on the order in which rows are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.rounding import exact_round, half_even_cents, scaled_round
from velotide.operators.sampling import sample_rows
from velotide.schemas import PRICING_ZONES

# Edges of the price histogram and the labels shown: fixed values.
PRICE_EDGES = [0.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 10.0]
PRICE_LABELS = [
    "<2.5", "2.5-3", "3-3.5", "3.5-4", "4-4.5", "4.5-5", "5-5.5", "5.5-6", "6-7", ">7",
]

DEMAND_CLIP = 80


def mean_of_cents(amount: Column, rows: Column | None = None) -> Column:
    """Exact mean of a two-decimal amount."""
    n = F.count(amount) if rows is None else rows
    return F.sum(half_even_cents(amount)) / n / 100.0


def zone_summary(priced: DataFrame) -> DataFrame:
    """Rows, percent and mean price of the four zones, absent ones with zero.

    One global aggregate; the four rows are unfolded from its single result.
    """
    zone, cents = F.col("pricing_zone"), half_even_cents(F.col("suggested_price"))
    totals = priced.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(zone == z).alias(f"n{i}") for i, z in enumerate(PRICING_ZONES)],
        *[F.sum(F.when(zone == z, cents)).alias(f"c{i}") for i, z in enumerate(PRICING_ZONES)],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("zone_order"),
            F.lit(z).alias("pricing_zone"),
            F.col(f"n{i}").alias("zone_rows"),
            F.when(F.col("total") > 0, F.col(f"n{i}") / F.col("total") * 100.0).alias("pct"),
            F.when(
                F.col(f"n{i}") > 0, F.col(f"c{i}") / F.col(f"n{i}") / 100.0
            ).alias("avg_price"),
        )
        for i, z in enumerate(PRICING_ZONES)
    ]
    return totals.select(F.inline(F.array(*rows)))


def zone_counts(priced: DataFrame) -> DataFrame:
    return (
        priced.groupBy("pricing_zone")
        .agg(F.count(F.lit(1)).alias("zone_rows"))
        .orderBy(F.desc("zone_rows"), "pricing_zone")
    )


def hourly_profile(priced: DataFrame) -> DataFrame:
    """Mean demand per hour of day with one decimal."""
    hour = F.col("hour") if "hour" in priced.columns else F.hour("event_hour")
    return (
        priced.groupBy(hour.alias("hour"))
        .agg(
            scaled_round(F.avg("bike_demand"), 1).alias("bike"),
            scaled_round(F.avg("dock_demand"), 1).alias("dock"),
        )
        .orderBy("hour")
    )


def price_histogram(priced: DataFrame) -> DataFrame:
    """Station-hours per price bin (lo, hi]; empty bins stay, others drop out.

    One global aggregate, no join against the bins.
    """
    price = F.col("suggested_price")
    bins = list(zip(PRICE_LABELS, PRICE_EDGES, PRICE_EDGES[1:], strict=False))
    counts = priced.agg(
        *[F.count_if((price > lo) & (price <= hi)).alias(f"n{i}") for i, (_, lo, hi) in enumerate(bins)]
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("bin_order"),
            F.lit(label).alias("bin_label"),
            F.lit(lo).alias("price_over"),
            F.lit(hi).alias("price_to"),
            F.col(f"n{i}").alias("bin_rows"),
        )
        for i, (label, lo, hi) in enumerate(bins)
    ]
    return counts.select(F.inline(F.array(*rows)))


def station_stats(priced: DataFrame) -> DataFrame:
    """Mean price, mean multiplier and share of Surge hours per station."""
    return priced.groupBy("station_id").agg(
        mean_of_cents(F.col("suggested_price")).alias("avg_price"),
        mean_of_cents(F.col("pricing_multiplier")).alias("avg_multiplier"),
        (F.count_if(F.col("pricing_zone") == "Surge") / F.count(F.lit(1)) * 100.0).alias("surge_pct"),
    )


def _top(stats: DataFrame, n: int, descending: bool) -> DataFrame:
    key = F.desc("avg_multiplier") if descending else F.asc("avg_multiplier")
    return stats.orderBy(key, "station_id").limit(n)


def _rounded(stats: DataFrame, rounding) -> DataFrame:
    return stats.withColumns(
        {
            "avg_price": rounding(F.col("avg_price"), 2),
            "avg_multiplier": rounding(F.col("avg_multiplier"), 2),
            "surge_pct": rounding(F.col("surge_pct"), 1),
        }
    )


def hotspots(priced: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` dearest and ``n`` cheapest stations, rounded after ranking."""
    stats = station_stats(priced)
    surge = _top(stats, n, descending=True).withColumn("side", F.lit("surge"))
    discount = _top(stats, n, descending=False).withColumn("side", F.lit("discount"))
    return _rounded(surge.unionByName(discount), exact_round).select(
        "side", "station_id", "avg_price", "avg_multiplier", "surge_pct"
    )


def top_surge_stations(priced: DataFrame, n: int = 10) -> DataFrame:
    return _rounded(_top(station_stats(priced), n, descending=True), scaled_round).select(
        "station_id", "avg_price", "avg_multiplier"
    )


def headline_figures(priced: DataFrame) -> DataFrame:
    return priced.agg(
        F.count(F.lit(1)).alias("station_hours"),
        F.countDistinct("station_id").alias("stations"),
        exact_round(mean_of_cents(F.col("pricing_multiplier")), 2).alias("avg_multiplier"),
        exact_round(mean_of_cents(F.col("suggested_price")), 2).alias("avg_price"),
    )


def demand_scatter(priced: DataFrame, n: int = 2000) -> DataFrame:
    """A sample of at most ``n`` station-hours, demand clipped for display."""

    def clipped(name: str) -> Column:
        return F.least(F.greatest(F.col(name), F.lit(0)), F.lit(DEMAND_CLIP)).alias(name)

    sample = sample_rows(priced, ["station_id", "event_hour"], n)
    return sample.select(
        "station_id", "event_hour", "pricing_zone", clipped("bike_demand"), clipped("dock_demand")
    )
