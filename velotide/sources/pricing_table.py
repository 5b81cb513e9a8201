"""Priced station-hours as CSV with header."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from velotide.schemas import PRICING

_TIME = "yyyy-MM-dd HH:mm:ss"


def write_pricing_csv(priced: DataFrame, path: str) -> DataFrame:
    """Write the table with the twelve declared columns; returns the table."""
    table = priced.select(PRICING.fieldNames())
    (
        table.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", _TIME)
        .csv(path)
    )
    return table


def read_pricing_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan; a path that does not exist gives the empty table."""
    try:
        return (
            spark.read.schema(PRICING)
            .option("header", True)
            .option("enforceSchema", False)
            .option("timestampNTZFormat", _TIME)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PRICING)
