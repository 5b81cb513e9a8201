"""Saved models applied to station-hours, as a table and as a stream."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from velotide.operators.pricing import decide_prices, with_stock_estimate
from velotide.sources.parquet import path_exists, read_parquet, write_parquet

SCORED_TARGETS = ("bike", "dock")
_FEATURE_LIST = "feature_list"


@dataclass(frozen=True)
class SavedModels:
    """Models by target and the features they were fitted on, in order."""

    columns: list[str]
    models: Mapping[str, Model]


def save_feature_list(spark: SparkSession, columns: list[str], model_dir: str) -> None:
    """Write the names and order of the features beside the models."""
    rows = spark.createDataFrame(list(enumerate(columns)), "position int, feature string")
    rows.coalesce(1).write.mode("overwrite").json(f"{model_dir.rstrip('/')}/{_FEATURE_LIST}")


def load_models(spark: SparkSession, model_dir: str) -> SavedModels:
    """What training saved: at least one of the two models, and their features."""
    base = model_dir.rstrip("/")
    listed = spark.read.schema("position int, feature string").json(f"{base}/{_FEATURE_LIST}")
    columns = [r["feature"] for r in listed.orderBy("position").collect()]
    places = {t: f"{base}/{t}_model" for t in SCORED_TARGETS}
    # The class of a model is named in its own metadata.
    models = {t: DefaultParamsReader.loadParamsInstance(p, spark) for t, p in places.items() if path_exists(spark, p)}
    if not models:
        raise ValueError(f"no saved models in {model_dir}")
    for target, model in models.items():
        if model.numFeatures != len(columns):
            raise ValueError(f"the {target} model takes {model.numFeatures} features, {len(columns)} are listed")
    return SavedModels(columns, models)


def check_features(hours: DataFrame, columns: list[str]) -> None:
    """Refuse a table that lacks a feature or holds one that is no number."""
    kinds = {f.name: f.dataType for f in hours.schema.fields}
    missing = [c for c in columns if c not in kinds]
    wrong = [c for c in columns if c in kinds and not isinstance(kinds[c], T.NumericType)]
    if missing or wrong:
        raise ValueError(f"features missing: {missing}, not numeric: {wrong}")


def score(hours: DataFrame, saved: SavedModels) -> DataFrame:
    """``hours`` with ``pred_bike`` and ``pred_dock``, for each model there is, and ``scored``.

    Rows with a null or NaN feature stay, without a prediction and with
    ``scored`` false.  Columns of these names are replaced, others pass through.
    Row by row, hence the same on a stream.
    """
    check_features(hours, saved.columns)
    inputs = {f"_feature_{i}": F.col(c).cast("double") for i, c in enumerate(saved.columns)}
    present = [x.isNotNull() & ~F.isnan(x) for x in inputs.values()]
    complete = reduce(and_, present, F.lit(True))
    kept = [c for c in hours.columns if c not in {"scored", *(f"pred_{t}" for t in saved.models)}]
    rows = hours.select(*kept, complete.alias("scored"), *[F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0)).alias(n) for n, x in inputs.items()])
    rows = VectorAssembler(inputCols=list(inputs), outputCol="_features").transform(rows).drop(*inputs)
    for target, model in saved.models.items():
        fitted = model.copy().setFeaturesCol("_features").setPredictionCol(f"pred_{target}")
        rows = fitted.transform(rows).withColumn(f"pred_{target}", F.when(F.col("scored"), F.col(f"pred_{target}")))
    return rows.select(*kept, *[f"pred_{t}" for t in saved.models], "scored")


def price_predictions(scored: DataFrame) -> DataFrame:
    """The decision rule on predicted instead of observed demand, for scored station-hours.

    Stock is estimated from ``capacity``; a prediction below zero counts as zero.
    """
    asked = with_stock_estimate(scored.where("scored")).withColumns(
        {f"predicted_{t}_demand": F.greatest(F.col(f"pred_{t}"), F.lit(0.0)) for t in SCORED_TARGETS}
    )
    return decide_prices(asked).select(
        "station_id", "event_hour", "available_bikes", "available_docks", "predicted_bike_demand",
        "predicted_dock_demand", "bike_gap", "dock_gap", "pricing_multiplier", "suggested_price_usd", "pricing_zone", "reason",
    )


def score_table(spark: SparkSession, silver_path: str, model_dir: str, out: str) -> DataFrame:
    """Score the table at ``silver_path`` and write it; returns rows and scored rows."""
    write_parquet(score(read_parquet(spark, silver_path), load_models(spark, model_dir)), out)
    return read_parquet(spark, out).agg(F.count(F.lit(1)).alias("rows"), F.count_if("scored").alias("scored_rows"))


def score_stream(
    spark: SparkSession, silver_path: str, model_dir: str, out: str, checkpoint: str, files_at_once: int = 64
) -> StreamingQuery:
    """Score the files that have arrived at ``silver_path`` since the last run, and end.

    Each file is scored once: the checkpoint remembers those that were read.
    ``out`` is appended to.
    """
    stream = (
        spark.readStream.schema(read_parquet(spark, silver_path).schema)
        .option("maxFilesPerTrigger", files_at_once)
        .parquet(silver_path)
    )
    scored = score(stream, load_models(spark, model_dir))
    writer = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
