"""What the corpus operators share: tables, batches and shared files."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.session import configure

# Rows in one Arrow batch.  Texts may be megabytes long, so batches are short.
BATCH_ROWS = 512

# The bytes that separate words: space and the controls from tab to return.
SPACES = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application.

    Functions that run in tasks import it there; a cluster need not have it
    installed.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="velotide-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the folder may be on any file system Spark reads."""
    configure(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def octets(name: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The given columns of every non-empty batch, as Python lists."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
