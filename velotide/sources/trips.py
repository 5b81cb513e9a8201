"""Trip files: CSV scan, file lineage, landing as Parquet."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide.schemas import RAW_TRIPS
from velotide.sources.parquet import located, write_parquet

# Text of a line that does not fit the trip schema; null for the others.
CORRUPT_LINE = "corrupt_line"


class Landed(NamedTuple):
    """Lines read, and where they went."""

    read: int
    landed: int
    quarantined: int


def read_trip_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = RAW_TRIPS,
    corrupt_column: str | None = None,
) -> DataFrame:
    """All ``*.csv`` files directly in ``folder`` as one frame.

    The schema is declared, so no inference pass runs over the files; a file
    whose header names other columns fails instead of being read shifted.
    A folder without such files is an error.  A line that does not fit keeps
    what can be read; with ``corrupt_column`` its text is kept there as well.
    """
    reader = spark.read.option("header", True)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .csv(f"{folder.rstrip('/')}/*.csv")
    )


def with_file_name(df: DataFrame) -> DataFrame:
    """Base name of the file each row came from; ``df`` must be a file scan."""
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def land_trip_files(spark: SparkSession, folder: str, out: str) -> int:
    """Write all rows of ``folder`` as Parquet and return how many were read.

    The count is observed while writing: one pass over the files.
    """
    seen = Observation("landed_trips")
    rows = with_file_name(read_trip_files(spark, folder))
    write_parquet(rows.observe(seen, F.count(F.lit(1)).alias("rows_read")), out)
    return seen.get["rows_read"]


def land_with_quarantine(spark: SparkSession, folder: str, out: str, quarantine: str) -> Landed:
    """Write rows that fit to ``out`` and lines that do not to ``quarantine``, in one pass.

    Both are Parquet with the columns of a trip (what could be read of it), its
    file and ``corrupt_line``, which is null in ``out``.  One job writes both side
    by side next to ``out``; then they are moved into place, replacing what was
    there, so nothing is replaced when that job fails.  Either may be empty.
    Counts are observed while writing.
    """
    seen = Observation("landed_trips")
    bad = F.col(CORRUPT_LINE).isNotNull()
    rows = with_file_name(read_trip_files(spark, folder, corrupt_column=CORRUPT_LINE)).withColumn("quarantined", bad)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if("quarantined").alias("quarantined"))
    staging = f"{out.rstrip('/')}-{uuid.uuid4().hex}"
    rows.write.partitionBy("quarantined").parquet(staging)
    for value, target in (("false", out), ("true", quarantine)):
        fs, place = located(spark, target)
        _, part = located(spark, f"{staging}/quarantined={value}")
        if not fs.exists(part):
            spark.createDataFrame([], rows.drop("quarantined").schema).write.parquet(part.toString())
        fs.delete(place, True)
        if place.getParent() is not None:
            fs.mkdirs(place.getParent())
        if not fs.rename(part, place):
            raise OSError(f"cannot move {part.toString()} to {target}")
    fs, rest = located(spark, staging)
    fs.delete(rest, True)
    counts = seen.get
    return Landed(counts["read"], counts["read"] - counts["quarantined"], counts["quarantined"])
