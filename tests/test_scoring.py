"""Saved models on tables and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from velotide.plans.scoring import SavedModels, check_features, load_models, price_predictions, score, score_stream, score_table
from velotide.plans.training import train
from velotide.sources.parquet import read_parquet, write_parquet

SMALL = {"numTrees": 5, "maxDepth": 5, "minInstancesPerNode": 1}


def hours(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        (i % 5).cast("string").alias("station_id"),
        (F.lit("2026-02-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.floor(i / 5).cast("int"))).alias("event_hour"),
        (i % 5 * 4 + F.floor(i / 5) % 24).alias("bike_demand"),
        (i % 9).alias("dock_demand"),
        F.when(i % 20 != 0, i % 11 / 11).alias("electric_ratio"),
        F.when(i % 20 != 1, i % 7 * 1.0).otherwise(float("nan")).alias("temp_c"),
        (F.floor(i / 5) % 24).cast("int").alias("hour"),
        (i % 6 * 5).cast("int").alias("capacity"),
        F.lit(2026).alias("year"),
    )


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models") / "rf")
    return folder, train(hours(spark), "rf", model_dir=folder, **SMALL)[1]


def test_loaded_models_say_what_fitted_ones_say(spark, saved):
    folder, fitted = saved
    loaded = load_models(spark, folder)
    assert loaded.columns == ["electric_ratio", "temp_c", "hour"] and set(loaded.models) == {"bike", "dock"}
    ours = score(hours(spark), loaded)
    assert ours.columns == [*hours(spark).columns, "pred_bike", "pred_dock", "scored"]
    again = score(hours(spark), SavedModels(loaded.columns, fitted))
    # One feature is NaN in places, which equals nothing.
    assert rows(ours.drop("temp_c")) == rows(again.drop("temp_c"))
    counts = ours.groupBy("scored").agg(F.count(F.lit(1)).alias("n"), F.count("pred_bike").alias("p"), F.count("pred_dock").alias("q"))
    assert {r["scored"]: tuple(r)[1:] for r in counts.collect()} == {True: (360, 360, 360), False: (40, 0, 0)}


def test_order_of_columns_and_extra_ones_do_not_matter(spark, saved):
    loaded = load_models(spark, saved[0])
    table = hours(spark)
    turned = table.select(*reversed(table.columns)).withColumns(
        {"features": F.lit("clash"), "pred_bike": F.lit("old"), "scored": F.lit(3), "rawFeatures": F.lit(1)}
    )
    got = score(turned, loaded)
    assert rows(got.select("station_id", "event_hour", "pred_bike")) == rows(score(table, loaded).select("station_id", "event_hour", "pred_bike"))
    assert got.where("features = 'clash'").count() == 400


def test_tables_that_do_not_fit_are_refused(spark, saved, tmp_path):
    loaded = load_models(spark, saved[0])
    with pytest.raises(ValueError, match=r"missing: \['temp_c'\], not numeric: \['hour'\]"):
        check_features(hours(spark).drop("temp_c").withColumn("hour", F.lit("8")), loaded.columns)
    only = SavedModels(loaded.columns, {"dock": loaded.models["dock"]})
    assert "pred_bike" not in score(hours(spark), only).columns
    spark.createDataFrame([(0, "hour")], "position int, feature string").write.json(str(tmp_path / "feature_list"))
    with pytest.raises(ValueError, match="no saved models"):
        load_models(spark, str(tmp_path))
    loaded.models["bike"].write().save(str(tmp_path / "bike_model"))
    with pytest.raises(ValueError, match="takes 3 features, 1 are listed"):
        load_models(spark, str(tmp_path))


def test_stream_scores_each_file_once(spark, saved, tmp_path):
    source, out, state, plain = (str(tmp_path / n) for n in ("silver", "scored", "state", "plain"))
    table = hours(spark)
    for part, mode in ((table.where("hour < 12"), "overwrite"), (table.where("hour >= 12"), "append")):
        part.write.mode(mode).parquet(source)
        score_stream(spark, source, saved[0], out, state, files_at_once=2).awaitTermination()
        assert read_parquet(spark, out).count() == read_parquet(spark, source).count()
    score_stream(spark, source, saved[0], out, state).awaitTermination()
    counts = score_table(spark, source, saved[0], plain).first()
    assert tuple(counts) == (400, 360)
    assert rows(read_parquet(spark, out).drop("temp_c")) == rows(read_parquet(spark, plain).drop("temp_c"))


def test_month_folders_can_be_streamed(spark, saved, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("silver", "scored", "state"))
    write_parquet(hours(spark), source, partition_by=["year"])
    score_stream(spark, source, saved[0], out, state).awaitTermination()
    assert read_parquet(spark, out).where("year = 2026").count() == 400


def test_prices_of_predictions(spark, saved):
    priced = price_predictions(score(hours(spark), load_models(spark, saved[0])))
    assert priced.count() == 360 and priced.where("predicted_bike_demand < 0 OR suggested_price_usd IS NULL").count() == 0
    below = hours(spark, 1).withColumns({"pred_bike": F.lit(-3.0), "pred_dock": F.lit(0.0), "scored": F.lit(True)})
    assert price_predictions(below).first()["predicted_bike_demand"] == 0.0
