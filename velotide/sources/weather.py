"""Daily weather CSV with lead lines above the header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header names of the export and our columns: fixed values of the format.
MEASURES = {
    "temperature_2m_mean (°C)": "temp_c",
    "precipitation_sum (mm)": "precip_mm",
    "wind_speed_10m_max (km/h)": "wind_kmh",
}
DATE_HEADER = "time"
DATA_LINE = r"^\d{4}-\d{2}-\d{2},"


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """date, temp_c, precip_mm, wind_kmh; one row per day of the file.

    Lines above the header are lead lines.  Columns are taken by header name,
    so an export with more measures or another order reads the same.
    """
    lines = spark.read.text(path)
    header = lines.where(F.col("value").startswith(f"{DATE_HEADER},")).first()
    if header is None:
        raise ValueError(f"no header line starting with '{DATE_HEADER},' in {path}")
    names = header["value"].strip().split(",")
    missing = [name for name in MEASURES if name not in names]
    if missing:
        raise ValueError(f"weather file lacks {missing}")
    return (
        lines.where(F.col("value").rlike(DATA_LINE))
        .select(F.split(F.trim("value"), ",").alias("cell"))
        .select(
            F.to_date(F.col("cell")[names.index(DATE_HEADER)]).alias("date"),
            *[
                F.expr(f"try_cast(nullif(cell[{names.index(name)}], '') AS double)").alias(column)
                for name, column in MEASURES.items()
            ],
        )
    )
