"""Intermediate tables in the folder shared by the whole cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
# Spark's own setting: remove an execution's shuffle files when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Files a task writes side by side; rows for more of them are sorted first.
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_local: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """New folder name under the cluster's checkpoint folder.

    The folder is removed when the driver's JVM ends.  Only a local session
    without that setting falls back to one temporary folder a session.
    """
    base = spark.conf.get(_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{_KEY} must name a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="velotide-")
        base = _local[app]
    path = f"{base.rstrip('/')}/velotide/{label}-{uuid.uuid4().hex}"
    fs, jvm_path = _located(spark, path)
    fs.deleteOnExit(jvm_path)
    return path


def _located(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    conf = spark.conf
    before = conf.get(key, None)
    conf.set(key, value)
    try:
        yield
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def _write(df: DataFrame, path: str) -> None:
    """Write the table and free the shuffles behind it, which nothing reads again."""
    with _set(df.sparkSession, _CLEANUP, "true"):
        df.write.parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends at a durable, columnar
    table, so later readers prune columns and a lost executor repeats nothing
    upstream."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_in_buckets(df: DataFrame, label: str, count: int, *keys: str) -> DataFrame:
    """``materialize`` in ``count`` buckets by ``keys``: joins by them shuffle only the other table.

    Tasks of ``df`` that hold a bucket each write one file each, and sort nothing for it.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    with _set(spark, _CLEANUP, "true"), _set(spark, _WRITERS, "1"):
        df.write.format("parquet").bucketBy(count, *keys).option("path", scratch_path(spark, label)).saveAsTable(name)
    stored = spark.table(name)
    # The table is external: its name goes, its files stay.
    spark.sql(f"DROP TABLE {name}")
    return stored


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialize`` for a table that is done with at the end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _write(df, path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, jvm_path = _located(spark, path)
        fs.delete(jvm_path, True)
