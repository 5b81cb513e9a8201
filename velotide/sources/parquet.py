"""Parquet scan and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def located(spark: SparkSession, path: str):
    """Hadoop file system and path of any address Spark reads."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = located(spark, path)
    return fs.exists(jvm_path)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; where nothing is, a table of ``schema`` without rows."""
    return read_parquet(spark, path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _reads_from(df: DataFrame, path: str) -> bool:
    """Whether a file scan of ``df`` has its root at, above or below ``path``."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    def qualified(jvm_path) -> str:
        return jvm_path.getFileSystem(hadoop).makeQualified(jvm_path).toString().rstrip("/") + "/"

    target = qualified(spark._jvm.org.apache.hadoop.fs.Path(path))
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            for j in range(roots.size()):
                root = qualified(roots.apply(j))
                if root.startswith(target) or target.startswith(root):
                    return True
    return False


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df``, by default replacing what ``path`` holds.

    Overwriting clears the folder before rows are read, so a plan that reads
    ``path`` itself is refused.  With ``partition_by`` the rows are rebalanced
    first: each folder gets a few files of good size, and adaptive execution
    splits a folder that holds much more than the others.
    """
    if mode == "overwrite" and _reads_from(df, path):
        raise ValueError(f"the plan reads the folder it would replace: {path}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
