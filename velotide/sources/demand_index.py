"""The demand index as stored tables: aggregated once, laid out for the lookups.

Station-hours are in buckets by (station, hour), one sorted file each, so that
a lookup shuffles its requests only; the means by hour of day lie beside them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.operators.lookup import DemandIndex, demand_index
from velotide.sources.parquet import located, read_parquet

KEYS = ["station_id", "event_hour"]
_COLUMNS = "station_id STRING, event_hour TIMESTAMP_NTZ, station_bikes DOUBLE, station_docks DOUBLE"
# The number of buckets is part of the layout; it is kept as a table of one row.
_PARTS = {"stations": "stations", "hours": "hours", "layout": "layout"}


def write_demand_index(history: DataFrame, path: str, buckets: int | None = None) -> DemandIndex:
    """Aggregate ``history`` and store it at ``path``, replacing an index there; returns what was stored.

    ``buckets`` is the number of files, by default the number of shuffle
    partitions.  Rows without a station or hour answer no request and are left out.
    """
    spark = history.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = demand_index(history)
    known = index.by_station.dropna(subset=KEYS).select(
        "station_id", F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "station_bikes", "station_docks"
    )
    base, name = path.rstrip("/"), _table_name(path, "written")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    fs, folder = located(spark, base)
    fs.delete(folder, True)
    # One task a bucket, hence one file a bucket.
    writer = known.repartition(count, *KEYS).write.bucketBy(count, *KEYS).sortBy(*KEYS)
    writer.option("path", f"{base}/{_PARTS['stations']}").format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    index.by_hour.coalesce(1).write.parquet(f"{base}/{_PARTS['hours']}")
    spark.createDataFrame([(count,)], "buckets int").coalesce(1).write.parquet(f"{base}/{_PARTS['layout']}")
    return read_demand_index(spark, path)


def read_demand_index(spark: SparkSession, path: str) -> DemandIndex:
    """The stored index; its buckets are made known to this session's catalog."""
    base, name = path.rstrip("/"), _table_name(path, "read")
    buckets = read_parquet(spark, f"{base}/{_PARTS['layout']}").first()["buckets"]
    place = f"{base}/{_PARTS['stations']}".replace("'", "\\'")
    keys = ", ".join(KEYS)
    # The table is external: dropping it leaves the files.
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({_COLUMNS}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return DemandIndex(spark.table(name), read_parquet(spark, f"{base}/{_PARTS['hours']}"))


def _table_name(path: str, use: str) -> str:
    return f"demand_index_{use}_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"
