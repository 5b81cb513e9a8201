"""Registered queries: every operator on the adapted test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry.adapter import AS_OF, Tables
from velotide.functions import pricing as rule
from velotide.functions.geo import haversine_m
from velotide.operators import categories, demand, enrich, features, geodesic, pricing, reports, sampling, spatial, trips
from velotide.operators.features import NOT_FEATURES, NOT_TRAINING_FEATURES, feature_columns
from velotide.operators.lookup import demand_by_hour_of_day, lookup_demand
from velotide.operators.models import SEARCH_SPACE, regression_metrics
from velotide.operators.stock import running_stock, with_default_stock
from velotide.plans import gold, scoring, serving, training
from velotide.plans.bronze import run_bronze
from velotide.sources.parquet import read_parquet, write_parquet
from velotide.sources.pricing_table import read_pricing_csv, write_pricing_csv
from velotide.sources.scratch import materialize, scratch_path
from velotide.sources.station_feed import read_station_feed
from velotide.sources.trips import CORRUPT_LINE, land_with_quarantine, read_trip_files, with_file_name
from velotide.sources.weather import DATE_HEADER, MEASURES, read_weather

Query = Callable[[Tables], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query):
        return lambda spark, sf_dir: function(Tables(spark, sf_dir))

    return {name: bind(function) for name, function in _QUERIES.items()}


def comparable(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Round irrational results so that two engines agree; no negative zero."""
    scale = float(10**digits)
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale + F.lit(0.0) for c in columns})


CYCLES = ["hour_sin", "hour_cos", "weekday_sin", "weekday_cos"]


# Sources and sinks


def _trip_folder(t: Tables) -> str:
    folder = scratch_path(t.spark, "trips-csv")
    t.raw.write.option("header", True).csv(folder)
    return folder


@query("scan_trips_csv")
def _scan_trips_csv(t: Tables) -> DataFrame:
    return read_trip_files(t.spark, _trip_folder(t))


def _trip_folder_with_bad_lines(t: Tables) -> str:
    """The same files, and for some events a line whose latitude is no number."""
    folder = _trip_folder(t)
    bad = t.raw.where("CAST(ride_id AS BIGINT) % 70 = 3").dropDuplicates(["ride_id"])
    bad = bad.withColumn("start_lat", F.lit("north"))
    bad.write.mode("append").option("header", True).csv(folder)
    return folder


@query("trips_file_name")
def _trips_file_name(t: Tables) -> DataFrame:
    """Rides per kind of file name: every row comes from a CSV part."""
    rows = with_file_name(read_trip_files(t.spark, _trip_folder(t)))
    return rows.select("ride_id", F.regexp_extract("file_name", r"\.(\w+)$", 1).alias("file_suffix"))


@query("ingest_report")
def _ingest_report(t: Tables) -> DataFrame:
    """Lines read, landed and quarantined, counted in the tables that were written, and whose rides were refused."""
    out, refused = scratch_path(t.spark, "raw-trips"), scratch_path(t.spark, "refused")
    counts = land_with_quarantine(t.spark, _trip_folder_with_bad_lines(t), out, refused)
    ride = F.substring_index(CORRUPT_LINE, ",", 1).cast("bigint")
    bad = read_parquet(t.spark, refused).agg(
        F.count(CORRUPT_LINE).alias("rows_quarantined"), F.sum(ride).alias("rides_quarantined")
    )
    good = read_parquet(t.spark, out).where(F.col(CORRUPT_LINE).isNull()).agg(F.count(F.lit(1)).alias("rows_landed"))
    return good.join(bad).withColumn("rows_read", F.lit(counts.read).cast("bigint"))


@query("scan_parquet")
def _scan_parquet(t: Tables) -> DataFrame:
    return read_parquet(t.spark, f"{t.sf_dir}/events.parquet")


@query("write_read_roundtrip")
def _write_read_roundtrip(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "hourly")
    hourly = demand.with_calendar(demand.hourly_demand(trips.trip_events(t.trips)))
    write_parquet(hourly.select("station_id", "event_hour", "bike_demand", "dock_demand", "year", "month"),
                  out, partition_by=["year", "month"])
    return read_parquet(t.spark, out)


@query("station_feed")
def _station_feed(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "feed")
    t.feed_documents.write.option("maxRecordsPerFile", 1).text(out)
    return read_station_feed(t.spark, out)


@query("weather_daily")
def _weather_daily(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "weather")
    lead = ["latitude,longitude,elevation", "40.7,-74.0,10", "", ",".join([DATE_HEADER, *MEASURES])]
    lines = t.spark.createDataFrame([(i, "", text) for i, text in enumerate(lead)], "n int, day string, value string")
    days = t.weather.select(
        F.lit(len(lead)).alias("n"),
        F.col("date").cast("string").alias("day"),
        F.concat_ws(",", F.col("date"), "temp_c", "precip_mm", "wind_kmh").alias("value"),
    )
    lines.unionByName(days).orderBy("n", "day").select("value").write.text(out)
    return read_weather(t.spark, out).withColumn("date", F.col("date").cast("string"))


@query("pricing_csv_roundtrip")
def _pricing_csv_roundtrip(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "pricing")
    write_pricing_csv(t.priced, out)
    return read_pricing_csv(t.spark, out)


@query("model_roundtrip")
def _model_roundtrip(t: Tables) -> DataFrame:
    """Saved and loaded steps give the features of the fitted ones."""
    folder = scratch_path(t.spark, "gold-model")
    silver = t.silver_table
    _, model = gold.gold_features(silver, k=5)
    model.write().overwrite().save(folder)
    loaded = PipelineModel.load(folder)

    def digest(fitted):
        return F.sum(F.xxhash64(vector_to_array("pca_features")).cast("decimal(38,0)"))

    table = model.transform(silver).agg(F.count(F.lit(1)).alias("rows"), digest(model).alias("fitted"))
    again = loaded.transform(silver).agg(digest(loaded).alias("loaded"))
    row, other = table.first(), again.first()
    return t.spark.createDataFrame(
        [(row["rows"], row["fitted"] == other["loaded"])], "rows bigint, same_features boolean"
    )


@query("training_summary")
def _training_summary(t: Tables) -> DataFrame:
    """The summary read back from the JSON written by training."""
    out = scratch_path(t.spark, "summary")
    summary, _ = training.train(t.silver_table, "rf", summary_path=out)
    return _summary_facts(t.spark.read.schema(summary.schema).json(out))


def _summary_facts(summary: DataFrame) -> DataFrame:
    """What can be stated of a training summary beforehand."""
    shares = F.col("top_features.importance")
    fall = F.array_sort(shares, lambda a, b: F.signum(b - a).cast("int")) == shares
    agree = F.lit(True)
    for part in ("val", "test"):
        rmse, mae, r2 = (F.col(f"{part}_{m}") for m in ("rmse", "mae", "r2"))
        agree = agree & (mae >= 0) & (rmse >= mae) & (r2 <= 1)
    return summary.select(
        "kind", "model", "feature_set", "val_rows", "test_rows", F.size("top_features").alias("named_features"),
        (fall & (F.try_element_at(shares, F.lit(1)) <= 1) & (F.try_element_at(shares, F.lit(-1)) >= 0)).alias("importances_fall"),
        agree.alias("metrics_agree"),
    )


# Cleaning


@query("parse_timestamps")
def _parse_timestamps(t: Tables) -> DataFrame:
    return trips.parse_trip_times(t.raw).select("ride_id", "started_at", "ended_at")


@query("drop_missing_station")
def _drop_missing_station(t: Tables) -> DataFrame:
    return trips.with_both_stations(t.raw).select("ride_id", "start_station_id", "end_station_id")


@query("dedup_rides")
def _dedup_rides(t: Tables) -> DataFrame:
    return trips.first_ride_copy(trips.parse_trip_times(t.raw))


@query("bronze_trips")
def _bronze_trips(t: Tables) -> DataFrame:
    return trips.without_station_attributes(t.clean)


@query("bronze_report")
def _bronze_report(t: Tables) -> DataFrame:
    raw, out, stations = (scratch_path(t.spark, n) for n in ("raw", "bronze-trips", "bronze-stations"))
    write_parquet(t.raw, raw)
    return run_bronze(t.spark, raw, out, stations)


@query("station_dim")
def _station_dim(t: Tables) -> DataFrame:
    return t.stations


@query("trip_events")
def _trip_events(t: Tables) -> DataFrame:
    return trips.trip_events(t.trips)


# Station-hours


@query("hourly_demand")
def _hourly_demand(t: Tables) -> DataFrame:
    return demand.hourly_sums(trips.trip_events(t.trips))


@query("hourly_ratios")
def _hourly_ratios(t: Tables) -> DataFrame:
    return _hourly(t)


def _hourly(t: Tables) -> DataFrame:
    return demand.hourly_demand(trips.trip_events(t.trips))


def _hours(t: Tables) -> DataFrame:
    return _hourly(t).select("station_id", "event_hour")


@query("time_features")
def _time_features(t: Tables) -> DataFrame:
    return demand.with_calendar(_hours(t))


@query("cyclic_features")
def _cyclic_features(t: Tables) -> DataFrame:
    cycles = demand.with_cycles(demand.with_calendar(_hours(t)))
    return comparable(cycles.select("station_id", "event_hour", *CYCLES), *CYCLES)


@query("holiday_flag")
def _holiday_flag(t: Tables) -> DataFrame:
    return enrich.with_holiday(_hours(t))


@query("weather_join")
def _weather_join(t: Tables) -> DataFrame:
    return enrich.with_weather(_hours(t), t.weather)


@query("capacity_join")
def _capacity_join(t: Tables) -> DataFrame:
    return enrich.with_capacity(_hours(t), t.capacities)


@query("haversine")
def _haversine(t: Tables) -> DataFrame:
    """Distance of every trip between its two stations."""
    metres = haversine_m(*[F.col(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")])
    distances = trips.with_both_stations(t.raw).select(
        "ride_id", "started_at", metres.alias("metres")
    )
    return comparable(distances, "metres", digits=4)


@query("spatial_capacity")
def _spatial_capacity(t: Tables) -> DataFrame:
    return t.matches


@query("silver_hourly")
def _silver_hourly(t: Tables) -> DataFrame:
    return comparable(t.silver, *CYCLES)


@query("join_coverage")
def _join_coverage(t: Tables) -> DataFrame:
    """Row coverage of the joins, and station coverage of the spatial match."""
    rows = enrich.join_coverage(t.silver)
    stations = spatial.match_coverage(t.capacities)
    measures = ["total_rows", "weather_matched", "weather_missing", "capacity_known"]
    station_measures = ["stations", "stations_matched", "stations_with_capacity"]
    return rows.unpivot([], measures, "measure", "value").unionByName(
        stations.unpivot([], station_measures, "measure", "value")
    )


# Pricing and reports


@query("stock_estimate")
def _stock_estimate(t: Tables) -> DataFrame:
    return pricing.with_stock_estimate(t.matches.select("station_id", "capacity"))


@query("supply_gap")
def _supply_gap(t: Tables) -> DataFrame:
    return t.priced.select(
        "station_id", "event_hour", "available_bikes", "available_docks", "bike_gap", "dock_gap"
    )


@query("price_multiplier")
def _price_multiplier(t: Tables) -> DataFrame:
    return t.priced.select("station_id", "event_hour", "pricing_multiplier")


@query("pricing_analysis")
def _pricing_analysis(t: Tables) -> DataFrame:
    return t.priced


@query("price_decision")
def _price_decision(t: Tables) -> DataFrame:
    """The decision rule on all station-hours; demand scaled so that fractions occur."""
    hours = pricing.with_stock_estimate(t.silver).select(
        "station_id", "event_hour", "available_bikes", "available_docks",
        (F.col("bike_demand") * 1.05).alias("predicted_bike_demand"),
        (F.col("dock_demand") * 1.35).alias("predicted_dock_demand"),
    )
    return pricing.decide_prices(hours)


@query("zone_summary")
def _zone_summary(t: Tables) -> DataFrame:
    return reports.zone_summary(t.priced)


@query("zone_counts")
def _zone_counts(t: Tables) -> DataFrame:
    return reports.zone_counts(t.priced)


@query("hourly_profile")
def _hourly_profile(t: Tables) -> DataFrame:
    return reports.hourly_profile(t.priced)


@query("price_histogram")
def _price_histogram(t: Tables) -> DataFrame:
    return reports.price_histogram(t.priced)


@query("station_stats")
def _station_stats(t: Tables) -> DataFrame:
    return reports.station_stats(t.priced)


@query("hotspots")
def _hotspots(t: Tables) -> DataFrame:
    return reports.hotspots(t.priced)


@query("top_surge_stations")
def _top_surge_stations(t: Tables) -> DataFrame:
    return reports.top_surge_stations(t.priced)


@query("headline_kpis")
def _headline_kpis(t: Tables) -> DataFrame:
    return reports.headline_figures(t.priced)


@query("demand_scatter")
def _demand_scatter(t: Tables) -> DataFrame:
    return reports.demand_scatter(t.priced)


# Serving


@query("demand_heuristic")
def _demand_heuristic(t: Tables) -> DataFrame:
    bikes, docks = rule.heuristic_demand(F.col("asked_at"))
    asked = serving.checked_requests(t.price_requests).where("error IS NULL")
    return asked.select("request_id", bikes.alias("bike_demand"), docks.alias("dock_demand"))


@query("demand_lookup")
def _demand_lookup(t: Tables) -> DataFrame:
    asked = serving.checked_requests(t.price_requests).select("request_id", "station_id", "asked_at")
    return comparable(
        lookup_demand(asked, t.hourly_table), "predicted_bike_demand", "predicted_dock_demand"
    )


@query("price_requests")
def _price_requests(t: Tables) -> DataFrame:
    return serving.answer_requests(t.price_requests, t.demand_index)


@query("station_forecast")
def _station_forecast(t: Tables) -> DataFrame:
    return serving.forecast(t.forecast_requests, t.hourly_table, AS_OF)


def _series(t: Tables) -> DataFrame:
    known = t.capacities.where("capacity > 0").select("station_id", "capacity")
    return t.hourly_table.join(known, "station_id", "left")


@query("running_stock")
def _running_stock(t: Tables) -> DataFrame:
    return running_stock(with_default_stock(_series(t)))


@query("price_series")
def _price_series(t: Tables) -> DataFrame:
    return serving.price_series(_series(t))


# Samples, features, models


@query("sample_rows")
def _sample_rows(t: Tables) -> DataFrame:
    return sampling.sample_rows(_hourly(t), ["station_id", "event_hour"], 5000)


@query("stratified_sample")
def _stratified_sample(t: Tables) -> DataFrame:
    """Two hundred station-hours of every hour of day."""
    return sampling.stratified_sample(_hourly(t), ["station_id", "event_hour"], F.hour("event_hour"), 200)


@query("great_circle_capacity")
def _great_circle_capacity(t: Tables) -> DataFrame:
    """Feed stations within 100 metres by great circle alone; distances to the millimetre."""
    matches = geodesic.match_by_great_circle(materialize(trips.station_dimension(t.bronze), "stations"), materialize(t.feed, "feed"))
    return comparable(matches, "metres", digits=3)


@query("split_rows")
def _split_rows(t: Tables) -> DataFrame:
    keys = training.ROW_KEY
    return _hours(t).select(*keys, sampling.split_column(keys, training.TRAINING_PARTS).alias("part"))


@query("feature_columns")
def _feature_columns(t: Tables) -> DataFrame:
    """Features of both variants with their number of values."""
    silver = t.silver
    variants = {"gold": NOT_FEATURES, "training": NOT_TRAINING_FEATURES}
    names = {v: feature_columns(silver, exclude) for v, exclude in variants.items()}
    every = sorted({c for columns in names.values() for c in columns})
    counts = silver.agg(*[F.count(c).alias(c) for c in every])
    rows = [
        F.struct(
            F.lit(variant).alias("variant"), F.lit(i + 1).alias("position"),
            F.lit(c).alias("feature"), F.col(c).alias("value_count"),
        )
        for variant, columns in names.items()
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


@query("assembled_rows")
def _assembled_rows(t: Tables) -> DataFrame:
    return features.assembly_report(t.silver, feature_columns(t.silver))


@query("standardized")
def _standardized(t: Tables) -> DataFrame:
    silver = t.silver_table
    columns = feature_columns(silver)
    scaled = features.fit_scaling(silver, columns).transform(silver)
    values = scaled.select(
        "station_id", "event_hour", vector_to_array("scaled_features").alias("v")
    ).select("station_id", "event_hour", *[F.col("v")[i].alias(c) for i, c in enumerate(columns)])
    return comparable(values, *columns, digits=6)


CATEGORIES = ["station_id", "hour"]
MIN_ROWS = 25


@query("category_index")
def _category_index(t: Tables) -> DataFrame:
    """Every category of the training rows with its rows and place; those of few rows share the last."""
    rows = _training_rows(t)
    counts = categories.category_counts(rows, CATEGORIES)
    place = F
    for index in categories.category_index(rows, CATEGORIES, MIN_ROWS):
        column, output = index.getInputCol(), index.getOutputCol()
        counts = index.setInputCol("category").transform(counts)
        place = place.when(F.col("column") == column, F.col(output))
    return counts.select("column", "category", "rows", place.cast("int").alias("place"))


@query("encoded_categories")
def _encoded_categories(t: Tables) -> DataFrame:
    """Slots of all rows by an index of the training rows: where the stations' and hours' are, and their values."""
    rows = _training_rows(t)
    stages = categories.category_stages(categories.category_index(rows, CATEGORIES, MIN_ROWS))
    encoded = Pipeline(stages=stages).fit(rows).transform(t.silver_table)
    encoded = encoded.withColumn("filled", categories.filled_slots("raw_categories"))
    station, hour = F.col("filled")[0], F.col("filled")[1]
    slots = encoded.select(
        "station_id", "event_hour", categories.slot_count("raw_categories").alias("slots"), F.size("filled").alias("filled_slots"),
        station.alias("station_slot"), hour.alias("hour_slot"),
        categories.slot_value("scaled_categories", station).alias("station_value"),
        categories.slot_value("scaled_categories", hour).alias("hour_value"),
    )
    return comparable(slots, "station_value", "hour_value", digits=6)


def _training_rows(t: Tables) -> DataFrame:
    part = sampling.split_column(["station_id", "event_hour"], training.TRAINING_PARTS)
    return t.silver_table.filter(part == "train")


def _gold(t: Tables, k: int) -> DataFrame:
    return gold.gold_features(t.silver_table, k)[0]


@query("pca_components")
def _pca_components(t: Tables) -> DataFrame:
    """Facts of the five components of all rows: means, variances and correlations, in one aggregate."""
    names = [f"pc{i}" for i in range(1, 6)]
    v = vector_to_array("pca_features")
    table = _gold(t, 5).select(*[v[i].alias(c) for i, c in enumerate(names)])
    pairs = [F.abs(F.covar_samp(a, b)) for i, a in enumerate(names) for b in names[:i]]
    facts = table.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(c).alias(f"mean_{c}") for c in names],
        *[F.var_samp(c).alias(f"var_{c}") for c in names],
        F.greatest(*pairs).alias("cross"),
    )
    rows = [
        F.struct(
            F.lit(i).alias("component"), F.col("rows"), (F.abs(f"mean_{c}") < 1e-6).alias("centred"),
            (F.col(f"var_{c}") <= F.col(f"var_pc{max(1, i - 1)}") + 1e-9).alias("falling"),
            (F.col("cross") < 1e-6).alias("uncorrelated"),
        )
        for i, c in enumerate(names, 1)
    ]
    return facts.select(F.inline(F.array(*rows)))


@query("gold_features")
def _gold_features(t: Tables) -> DataFrame:
    """Keys and targets of all gold rows, and what holds for their eight components."""
    v = vector_to_array("pca_features")
    known = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    table = _gold(t, 8).withColumns({"components": F.size(v), "finite": known})
    return table.select("station_id", "event_hour", "bike_demand", "dock_demand", "components", "finite")


@query("pca_variance")
def _pca_variance(t: Tables) -> DataFrame:
    """Shares fall, running shares add them up, and those of the kept components end at one."""
    order = Window.orderBy("component")
    report = gold.component_report(t.silver_table, k=5).withColumns(
        {
            "before": F.lag("share", 1, 1.0).over(order),
            "sum": F.sum("share").over(order),
            "kept_sum": F.sum("kept_share").over(order),
            "all_kept": F.sum("kept_share").over(Window.partitionBy()),
        }
    )
    near = 1e-9
    return report.select(
        "component",
        ((F.col("share") > 0) & (F.col("share") <= F.col("before"))).alias("falling"),
        ((F.abs(F.col("sum") - F.col("cumulative_share")) < near) & (F.col("sum") <= 1 + near)).alias("adds_up"),
        ((F.abs(F.col("kept_sum") - F.col("cumulative_kept_share")) < near) & (F.abs(F.col("all_kept") - 1) < near)).alias("kept_adds_up"),
    )


def _predictions(t: Tables, kind: str) -> DataFrame:
    """All rows with both predictions; fits and scoring read rows assembled once."""
    data = training.training_data(t.silver_table)
    data = training.TrainingData(materialize(training.in_fit_order(data), "training-rows"), data.columns)
    scored = data.rows
    for model, _ in training.fit_targets(data, kind).values():
        scored = model.transform(scored)
    return scored


_TEST_KEYS = ["station_id", "event_hour", "bike_demand", "dock_demand"]


@query("rf_demand")
def _rf_demand(t: Tables) -> DataFrame:
    """Test rows; a forest averages training targets, so no prediction is outside their range."""
    scored = _predictions(t, "rf")
    fitted = scored.where("part = 'train'").agg(
        *[f(c).alias(f"{n}_{c}") for c in training.TARGETS.values() for n, f in (("low", F.min), ("high", F.max))]
    )
    within = {
        f"{target}_in_range": F.col(f"pred_{target}").between(F.col(f"low_{c}") - 1e-9, F.col(f"high_{c}") + 1e-9)
        for target, c in training.TARGETS.items()
    }
    return scored.where("part = 'test'").join(F.broadcast(fitted)).withColumns(within).select(*_TEST_KEYS, *within)


@query("gbt_demand")
def _gbt_demand(t: Tables) -> DataFrame:
    """Test rows, and whether both predictions are finite."""
    finite = F.lit(True)
    for target in training.TARGETS:
        p = F.col(f"pred_{target}")
        finite = finite & p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))
    return _predictions(t, "gbt").where("part = 'test'").select(*_TEST_KEYS, finite.alias("finite"))


@query("regression_metrics")
def _regression_metrics(t: Tables) -> DataFrame:
    """Metrics of the hour-of-day mean as a prediction, per part of the data."""
    hours = t.hourly_table.withColumn("hour_of_day", F.hour("event_hour"))
    by_hour = demand_by_hour_of_day(hours)
    scored = hours.join(F.broadcast(by_hour), "hour_of_day").withColumn(
        "part", sampling.split_column(training.ROW_KEY, training.TRAINING_PARTS)
    )
    metrics = regression_metrics(scored, "bike_demand", "hour_bikes", by=["part"])
    return comparable(metrics, "rmse", "r2", "mae", digits=6)


@query("train_summary")
def _train_summary(t: Tables) -> DataFrame:
    summary, _ = training.train(t.silver_table, "gbt")
    return _summary_facts(summary)


@query("param_search")
def _param_search(t: Tables) -> DataFrame:
    return training.search(t.silver_table, "rf", "bike")


@query("model_search")
def _model_search(t: Tables) -> DataFrame:
    """Facts of a model-based search of all 20 trials: points, space, the best one."""
    trials = training.search(t.silver_table, "rf", "dock", method="model")
    inside = F.lit(True)
    for name, (low, high, _) in SEARCH_SPACE["rf"].items():
        inside = inside & F.col("params")[name].between(low, high)
    best = F.when(F.col("is_best"), F.col("rmse"))
    rows = training.training_data(t.silver_table, parts=training.SEARCH_PARTS).part("validation").count()
    return trials.agg(
        F.count(F.lit(1)).cast("int").alias("trials"),
        F.count_distinct(F.to_json("params")).cast("int").alias("distinct_points"),
        F.every(inside).alias("in_space"),
        F.count(best).cast("int").alias("best_trials"),
        (F.max(best) == F.min("rmse")).alias("best_is_least"),
        F.lit(rows).cast("bigint").alias("validation_rows"),
    )


def _saved(t: Tables) -> tuple[str, dict]:
    """Both forests, fitted, saved and given back."""
    folder = scratch_path(t.spark, "models")
    return folder, training.train(t.silver_table, "rf", model_dir=folder)[1]


@query("score_saved_models")
def _score_saved_models(t: Tables) -> DataFrame:
    """All station-hours scored by loaded models, and whether the fitted ones say the same."""
    folder, fitted = _saved(t)
    saved = scoring.load_models(t.spark, folder)
    loaded = scoring.score(t.silver_table, saved)
    again = scoring.score(loaded.withColumnsRenamed({"pred_bike": "loaded_bike", "pred_dock": "loaded_dock"}),
                          scoring.SavedModels(saved.columns, fitted))
    same = F.col("pred_bike").eqNullSafe(F.col("loaded_bike")) & F.col("pred_dock").eqNullSafe(F.col("loaded_dock"))
    return again.select("station_id", "event_hour", "scored", same.alias("as_fitted"))


@query("score_stream")
def _score_stream(t: Tables) -> DataFrame:
    """Station-hours scored as they arrive as files, and whether the table's scores are the same."""
    folder, _ = _saved(t)
    source, out, state = (scratch_path(t.spark, n) for n in ("arriving", "scored", "scored-state"))
    write_parquet(t.silver_table, source)
    scoring.score_stream(t.spark, source, folder, out, state).awaitTermination()
    streamed = read_parquet(t.spark, out).select("station_id", "event_hour", "scored", "pred_bike", "pred_dock")
    table = scoring.score(t.silver_table, scoring.load_models(t.spark, folder)).select(
        "station_id", "event_hour", F.struct("pred_bike", "pred_dock").alias("p")
    )
    same = F.struct("pred_bike", "pred_dock").eqNullSafe(F.col("p"))
    return streamed.join(table, ["station_id", "event_hour"], "full").select(
        "station_id", "event_hour", "scored", same.alias("as_table")
    )
