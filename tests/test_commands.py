"""Jobs of the command line on inputs that may be missing, and their settings."""

from __future__ import annotations

import json

import pytest

from tests.test_scoring import hours as scored_hours
from velotide.__main__ import main
from velotide.plans.silver import run_silver
from velotide.schemas import FORECAST_REQUEST, PRICE_REQUEST, PRICING
from velotide.sources.parquet import read_parquet

REQUESTS = [(1, "1.10", "2026-1-5 8:05", False, None, None, None), (2, "1.10", "soon", False, 3, 4, 50)]


def write_requests(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("ask", "ahead", "out", "index")}
    spark.createDataFrame(REQUESTS, PRICE_REQUEST).write.option("header", True).csv(paths["ask"])
    spark.createDataFrame([(1, "1.10", None, None, None)], FORECAST_REQUEST).write.option("header", True).csv(paths["ahead"])
    return paths


def test_absent_history_is_an_empty_one(spark, tmp_path, capsys):
    p, none = write_requests(spark, tmp_path), str(tmp_path / "never-priced")
    main(["answer", "--requests", p["ask"], "--prices", none, "--out", p["out"] + "1"])
    first, second = read_parquet(spark, p["out"] + "1").orderBy("request_id").collect()
    # Rush hour on a Monday by the heuristic; one-digit times are read, stock left out is 15.
    assert (first.predicted_bike_demand, first.predicted_dock_demand, first.error) == (25.0, 22.5, None)
    assert second.error is not None and second.suggested_price_usd is None
    main(["forecast", "--requests", p["ahead"], "--prices", none, "--as-of", "2026-01-05 08:00:00", "--out", p["out"] + "2"])
    assert read_parquet(spark, p["out"] + "2").count() == 24
    main(["report", "--name", "zone-summary", "--prices", none])
    assert "Mild Surge" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["answer", "--requests", p["ask"], "--out", p["out"] + "3"])


def test_requests_are_answered_from_a_stored_index(spark, tmp_path, capsys):
    p, prices = write_requests(spark, tmp_path), str(tmp_path / "prices")
    empty = spark.createDataFrame([], PRICING)
    row = spark.sql("SELECT '1.10' station_id, TIMESTAMP_NTZ '2026-01-05 08:00:00' event_hour, 12L bike_demand, 4L dock_demand")
    empty.unionByName(row, allowMissingColumns=True).write.parquet(prices)
    main(["index", "--prices", prices, "--out", p["index"], "--buckets", "2"])
    assert "station-hours: 1, hours of day: 1" in capsys.readouterr().out
    main(["answer", "--requests", p["ask"], "--index", p["index"], "--out", p["out"]])
    assert read_parquet(spark, p["out"]).orderBy("request_id").first().predicted_bike_demand == 12.0


def test_absent_weather_file_leaves_the_stage_out(spark, tmp_path):
    from registry.adapter import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    feed = {"data": {"stations": [{"station_id": "f", "lat": 40.5, "lon": -74.0, "capacity": 8}]}}
    (tmp_path / "feed.json").write_text(json.dumps(feed))
    t.trips.write.parquet(str(tmp_path / "trips"))
    t.stations.write.parquet(str(tmp_path / "stations"))
    paths = [str(tmp_path / n) for n in ("trips", "stations", "feed.json", "out", "no-weather.csv")]
    run_silver(spark, *paths)
    assert "temp_c" not in read_parquet(spark, paths[3]).columns


def test_training_search_and_scoring_settings(spark, tmp_path, capsys, monkeypatch):
    from velotide.operators import models

    tiny = {"numTrees": (2, 6, 1), "maxDepth": (2, 4, 1)}
    monkeypatch.setitem(models.SEARCH_SPACE, "rf", tiny)
    monkeypatch.setitem(models.RF_DEFAULTS, "numTrees", 4)
    silver, model, out = (str(tmp_path / n) for n in ("silver", "model", "scored"))
    scored_hours(spark).write.parquet(silver)
    main(["train", "--silver", silver, "--model", model, "--summary", str(tmp_path / "s"), "--parts", "0.5,0.25,0.25", "--seed", "7"])
    summary = spark.read.json(str(tmp_path / "s")).collect()
    assert len(summary) == 2 and all(60 < r.test_rows < 120 for r in summary)
    with pytest.raises(SystemExit):
        main(["train", "--silver", silver, "--parts", "0.5,0.5"])
    main(["search", "--silver", silver, "--trials", "10", "--method", "model", "--parallel", "2", "--rows", "200",
          "--parts", "0.7,0.3", "--out", str(tmp_path / "trials"), "--summary", str(tmp_path / "search")])
    trials = spark.read.json(str(tmp_path / "trials"))
    assert trials.count() == 10 and trials.where("is_best").count() == 1
    assert [r["round"] for r in trials.select("round").distinct().orderBy("round").collect()] == [1, 2, 3, 4, 5]
    found = spark.read.json(str(tmp_path / "search")).first()
    assert found.best_rmse == min(t.rmse for t in found.trials) and len(found.trials) == 10
    assert set(found.best_params.asDict()) == set(tiny) and found.feature_cols == ["electric_ratio", "temp_c", "hour"]
    main(["score", "--silver", silver, "--model", model, "--out", out])
    assert "360" in capsys.readouterr().out and read_parquet(spark, out).count() == 400
    main(["score", "--silver", silver, "--model", model, "--out", out + "2", "--checkpoint", str(tmp_path / "state")])
    assert "rows scored: 400" in capsys.readouterr().out
