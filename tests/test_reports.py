from pyspark.sql import functions as F

from tests.helpers import at, rows
import pytest

from velotide.operators import reports
from velotide.operators.pricing import price_station_hours
from velotide.operators.sampling import bernoulli_sample, sample_rows, split_column
from velotide.schemas import PRICING


def priced(spark, table):
    """(station, hour, bike, dock, multiplier, price, zone) rows as a pricing table."""
    full = [(s, at(f"2026-01-05 {h:02d}:00:00"), b, d, 10, 5, 5, 5 - b, 5 - d, m, p, z) for s, h, b, d, m, p, z in table]
    return spark.createDataFrame(full, PRICING)


def small(spark):
    return priced(
        spark,
        [
            ("a", 8, 100, 1, 1.5, 6.74, "Surge"),
            ("a", 9, 2, -3, 1.19, 5.34, "Mild Surge"),
            ("b", 8, 1, 1, 1.0, 4.49, "Normal"),
            ("b", 9, 0, 0, 1.2, 5.39, "Mild Surge"),
            ("c", 8, 0, 0, 1.5, 6.74, "Surge"),
        ],
    )


def test_zone_summary_keeps_absent_zones(spark):
    got = reports.zone_summary(small(spark)).orderBy("zone_order").collect()
    assert [(r.pricing_zone, r.zone_rows, r.pct) for r in got] == [
        ("Surge", 2, 40.0), ("Mild Surge", 2, 40.0), ("Normal", 1, 20.0), ("Discount", 0, 0.0)]
    assert [r.avg_price for r in got] == [6.74, 5.365, 4.49, None]
    empty = reports.zone_summary(small(spark).where("false")).collect()
    assert [(r.zone_rows, r.pct, r.avg_price) for r in empty] == [(0, None, None)] * 4


def test_zone_counts_descend(spark):
    got = [tuple(r) for r in reports.zone_counts(small(spark)).collect()]
    assert got == [("Mild Surge", 2), ("Surge", 2), ("Normal", 1)]


def test_histogram_bins_are_open_left_closed_right(spark):
    prices = [0.0, 2.5, 2.51, 4.49, 4.5, 7.0, 7.01, 10.0, 10.01]
    table = priced(spark, [("a", i, 0, 0, 1.0, p, "Normal") for i, p in enumerate(prices)])
    table = table.unionByName(table.limit(1).withColumn("suggested_price", F.lit(None).cast("double")))
    got = reports.price_histogram(table).orderBy("bin_order").collect()
    assert [r.bin_rows for r in got] == [1, 1, 0, 0, 2, 0, 0, 0, 1, 2]
    assert got[-1].bin_label == ">7"


def test_hourly_profile_with_and_without_hour(spark):
    got = [tuple(r) for r in reports.hourly_profile(small(spark)).collect()]
    assert got == [(8, 33.7, 0.7), (9, 1.0, -1.5)]
    assert [tuple(r) for r in reports.hourly_profile(small(spark).withColumn("hour", F.hour("event_hour"))).collect()] == got


def test_hotspots_rank_before_rounding_and_break_ties_by_station(spark):
    got = reports.hotspots(small(spark), 2).collect()
    assert [(r.side, r.station_id) for r in got] == [("surge", "c"), ("surge", "a"), ("discount", "b"), ("discount", "a")]
    a = got[1]
    # 1.345 is a tie: half to even.
    assert (a.avg_price, a.avg_multiplier, a.surge_pct) == (6.04, 1.34, 50.0)
    assert reports.hotspots(small(spark).where("false")).count() == 0
    assert [r.station_id for r in reports.top_surge_stations(small(spark), 2).collect()] == ["c", "a"]


def test_headline_figures(spark):
    assert tuple(reports.headline_figures(small(spark)).first()) == (5, 3, 1.28, 5.74)


def test_scatter_clips(spark):
    got = rows(reports.demand_scatter(small(spark)).select("station_id", "bike_demand", "dock_demand"))
    assert ("a", 80, 1) in got and ("a", 2, 0) in got and len(got) == 5


def test_means_do_not_depend_on_partitions(spark):
    silver = spark.range(4000).select(
        F.concat((F.col("id") % 13).cast("string"), F.lit(".10")).alias("station_id"),
        (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.floor(F.col("id") / 13).cast("int"))).alias("event_hour"),
        (F.col("id") * 7 % 23).alias("bike_demand"),
        (F.col("id") * 5 % 19).alias("dock_demand"),
        (F.col("id") % 13 * 2).cast("int").alias("capacity"),
    )
    one, many = (price_station_hours(silver.repartition(n)) for n in (1, 9))
    for report in (reports.station_stats, reports.zone_summary, reports.headline_figures):
        assert rows(report(one)) == rows(report(many))


def test_sample_is_exact_and_independent_of_partitions(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), "id")
    first = rows(sample_rows(df, ["k"], 700))
    assert len(first) == 700
    assert rows(sample_rows(df.repartition(7), ["k"], 700)) == first
    smallest = df.orderBy(F.md5("k")).limit(700)
    assert rows(smallest) == first
    assert sample_rows(df, ["k"], 6000).count() == 5000


def test_split_is_stable_and_near_its_fractions(spark):
    df = spark.range(10_000).select(F.col("id").cast("string").alias("k"))
    part = split_column(["k"], {"train": 0.8, "validation": 0.1, "test": 0.1}).alias("part")
    counts = dict(rows(df.select(part).groupBy("part").count()))
    assert sum(counts.values()) == 10_000
    assert abs(counts["train"] - 8000) < 200 and abs(counts["test"] - 1000) < 150
    assert rows(df.select("k", part)) == rows(df.repartition(9).select("k", part))


def test_bernoulli_sample(spark):
    df = spark.range(4000)
    assert bernoulli_sample(df, ["id"], 4000, 42).count() == 4000
    some = bernoulli_sample(df, ["id"], 1000, 42)
    assert 800 < some.count() < 1200
    assert rows(some) == rows(bernoulli_sample(df.repartition(7), ["id"], 1000, 42))


def test_split_of_other_fractions(spark):
    df = spark.range(4000)
    cut = split_column(["id"], {"train": 0.9, "validation": 0.1, "test": 0.0}).alias("part")
    counts = {r["part"]: r["count"] for r in df.select(cut).groupBy("part").count().collect()}
    assert set(counts) == {"train", "validation"} and abs(counts["train"] - 3600) < 120
    assert df.select(split_column(["id"], {"a": 1.0, "b": 0.0}).alias("p")).where("p = 'a'").count() == 4000
    for wrong in ({"a": 0.5, "b": 0.4}, {"a": 1.5, "b": -0.5}):
        with pytest.raises(ValueError, match="fractions"):
            split_column(["id"], wrong)


def test_stratified_sample_is_exact_per_stratum(spark):
    from collections import Counter

    from velotide.operators.sampling import stratified_sample

    n = F.col("id")
    table = spark.range(3000).select(
        n.alias("key"), F.when(n % 3 == 0, 0).when(n % 3 == 1, n % 7).when(n % 50 != 2, 9).alias("hour"), F.lit("x").alias("_digest2")
    )
    got = stratified_sample(table, ["key"], F.col("hour"), 60)
    sizes = Counter(r["hour"] for r in table.collect())
    assert got.columns == table.columns and None in sizes
    assert Counter(r["hour"] for r in got.collect()) == {h: min(60, k) for h, k in sizes.items()}
    again = stratified_sample(table.repartition(7), ["key"], F.col("hour"), 60)
    assert sorted(r["key"] for r in got.collect()) == sorted(r["key"] for r in again.collect())
    assert stratified_sample(table.where("false"), ["key"], F.col("hour"), 5).count() == 0
