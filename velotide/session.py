"""Session settings the jobs rely on."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Every timestamp in the engine is a zone-free wall clock.  Two built-ins
# (date_trunc, try_to_timestamp) pass through the zoned type, so the session
# zone must be one without daylight-saving gaps.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Adaptive execution picks partition counts, splits skewed joins and turns a
# sort-merge join into a broadcast when the measured side is small enough.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "velotide", **conf: str) -> SparkSession:
    """Session for the command line; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Input bytes (compressed columns) aimed at per reducer, and the most reducers
# a driver can keep track of; beyond them sorts and aggregates spill.
_BYTES_PER_REDUCER = 256 * 1024 * 1024
_MOST_REDUCERS = 100_000
_PARTITIONS = "spark.sql.shuffle.partitions"


def reducers_for(total_bytes: int, configured: int) -> int:
    return max(configured, min(math.ceil(total_bytes / _BYTES_PER_REDUCER), _MOST_REDUCERS))


@contextmanager
def shuffle_sized_for(spark: SparkSession, path: str) -> Iterator[int]:
    """Enough shuffle partitions for the table at ``path`` within the block.

    Only ever raises the setting: adaptive execution merges partitions that
    turn out small, but cannot split an aggregate's partition that is too big.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    configured = spark.conf.get(_PARTITIONS)
    wanted = reducers_for(fs.getContentSummary(folder).getLength(), int(configured))
    spark.conf.set(_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(_PARTITIONS, configured)
