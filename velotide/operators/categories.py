"""Categorical columns as sparse vectors next to the numeric features."""

from __future__ import annotations

from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Length of the labels' list of one column, which the driver and the saved model hold
# (some tens of MB); the scaler's sums are as many numbers.
MAX_CATEGORIES = 1_000_000


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, category, rows)``: how often each value occurs, in one pass and one shuffle.

    Values are compared as text.  Nulls are no category.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
    unfolded = df.select(F.inline(F.array(*pairs))).filter(F.col("category").isNotNull())
    return unfolded.groupBy("column", "category").agg(F.count(F.lit(1)).alias("rows"))


def category_index(
    df: DataFrame, columns: list[str], min_rows: int = 1, max_categories: int = MAX_CATEGORIES
) -> list[StringIndexerModel]:
    """An index for each of ``columns``, places by frequency: the most frequent is 0, ties by code point.

    Values of fewer than ``min_rows`` rows, nulls, and values met only later
    share one slot behind the others.  A column with more than
    ``max_categories`` values of its own is refused: nothing is left out to make
    it fit.
    """
    if not columns:
        raise ValueError("no categorical columns")
    if min_rows < 1:
        raise ValueError(f"min_rows must be at least 1: {min_rows}")
    labels: dict[str, list[str]] = {c: [] for c in columns}
    frequent = category_counts(df, columns).filter(F.col("rows") >= min_rows)
    # One row more than fits for every column tells that one does not.
    most = len(columns) * max_categories + 1
    for row in frequent.orderBy("column", F.desc("rows"), "category").limit(most).collect():
        labels[row["column"]].append(row["category"])
    for column, values in labels.items():
        if len(values) > max_categories:
            raise ValueError(f"{column} has more than {max_categories} categories; raise min_rows")
    # A model a column: one of several columns would pad shorter lists with nulls.
    return [
        StringIndexerModel.from_labels(values, column, f"{column}_index", handleInvalid="keep")
        for column, values in labels.items()
    ]


def category_stages(index: list[StringIndexerModel], output: str = "scaled_categories") -> list:
    """Index, one slot a category, and slots divided by their deviation.

    Slots are not centred, which would fill every vector.  A slot that no fitted
    row is in has deviation 0 and stays 0.
    """
    slots = [f"{i.getInputCol()}_slots" for i in index]
    return [
        *index,
        OneHotEncoder(inputCols=[i.getOutputCol() for i in index], outputCols=slots, dropLast=False),
        VectorAssembler(inputCols=slots, outputCol="raw_categories"),
        StandardScaler(inputCol="raw_categories", outputCol=output, withMean=False, withStd=True),
    ]


def slot_count(vector: str) -> Column:
    """Length of the vectors of a column."""
    v = F.unwrap_udt(vector)
    return F.when(v["size"].isNull(), F.size(v["values"])).otherwise(v["size"])


def filled_slots(vector: str) -> Column:
    """Places whose value is not zero, ascending; a sparse vector is never filled up."""
    v = F.unwrap_udt(vector)
    places = F.transform(v["values"], lambda x, i: F.when(x != 0, F.when(v["size"].isNull(), i).otherwise(v["indices"][i])))
    return F.array_compact(places)


def slot_value(vector: str, place: Column) -> Column:
    """The value at ``place``."""
    v = F.unwrap_udt(vector)
    at = F.when(v["size"].isNull(), place + 1).otherwise(F.array_position(v["indices"], place))
    return F.when(at > 0, F.get(v["values"], (at - 1).cast("int"))).otherwise(0.0)
