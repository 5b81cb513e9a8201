"""Station-hours to standardized, reduced training features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from velotide.operators.categories import category_index, category_stages
from velotide.operators.features import (
    NOT_FEATURES,
    NOT_TRAINING_FEATURES,
    feature_columns,
    fit_scaling,
    scaling_stages,
    variance_table,
)
from velotide.sources.parquet import read_parquet, write_parquet

GOLD_COLUMNS = ["station_id", "event_hour", "pca_features", "scaled_features", "bike_demand", "dock_demand"]


def gold_features(silver: DataFrame, k: int = 8) -> tuple[DataFrame, PipelineModel]:
    """Gold table and the fitted steps.  ``k = 0`` keeps the scaled features."""
    model = fit_scaling(silver, feature_columns(silver), k)
    dropped = "scaled_features" if k > 0 else "pca_features"
    columns = [c for c in GOLD_COLUMNS if c != dropped]
    table = model.transform(silver)
    return table.select(*[c for c in columns if c in table.columns]), model


def encoded_features(
    silver: DataFrame, categories: list[str], k: int = 0, min_rows: int = 1
) -> tuple[DataFrame, PipelineModel]:
    """Gold table whose ``encoded_features`` also hold ``categories``, and the fitted steps.

    First the ``k`` components (or, with 0, the scaled features) of the numeric
    columns, then the slots of each category, see ``category_index``.  A column
    named as a category is no numeric feature.  The saved steps encode values
    they were not fitted on.
    """
    numeric = feature_columns(silver, NOT_FEATURES | set(categories))
    index = category_index(silver, categories, min_rows)
    first = "pca_features" if k > 0 else "scaled_features"
    joined = VectorAssembler(inputCols=[first, "scaled_categories"], outputCol="encoded_features")
    model = Pipeline(stages=[*scaling_stages(numeric, k), *category_stages(index), joined]).fit(silver)
    columns = ["station_id", "event_hour", "encoded_features", "bike_demand", "dock_demand"]
    table = model.transform(silver)
    return table.select(*[c for c in columns if c in table.columns]), model


def run_gold(
    spark: SparkSession, silver_path: str, out: str, model_dir: str, k: int = 8,
    categories: list[str] | None = None, min_rows: int = 1,
) -> None:
    silver = read_parquet(spark, silver_path)
    table, model = encoded_features(silver, categories, k, min_rows) if categories else gold_features(silver, k)
    model.write().overwrite().save(model_dir)
    write_parquet(table, out)


def component_report(
    silver: DataFrame, k: int = 5, model_dir: str | None = None
) -> DataFrame:
    """Explained variance of ``k`` components of the training features."""
    columns = feature_columns(silver, NOT_TRAINING_FEATURES)
    model = fit_scaling(silver, columns, k)
    if model_dir:
        model.stages[-1].write().overwrite().save(model_dir)
    return variance_table(model, silver)


