"""Compare registered queries with their SQL: ``python -m registry.check [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from registry.oracles import ORACLES
from registry.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, float):
        return repr(float(value))
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    columns = [[_cell(v) for v in frame[c].astype(object)] for c in frame.columns]
    return sorted(zip(*columns, strict=True))


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None when equal as bags of rows, else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    kinds = {
        c: (ours[c].dtype.name, theirs[c].dtype.name)
        for c in ours.columns
        if ours[c].dtype.kind != theirs[c].dtype.kind
    }
    # A whole-number column with nulls is one of floats in pandas.
    for c, pair in kinds.items():
        if {k[:3].lower() for k in pair} == {"flo", "int"}:
            ours, theirs = ours.astype({c: "Float64"}), theirs.astype({c: "Float64"})
    a, b = rows_of(ours), rows_of(theirs)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} rows, first {bad[0]}, kinds {kinds}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries = registered()
    names = argv[1:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="velotide-tables-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        began = time.monotonic()
        try:
            ours = queries[name](spark, sf_dir).toPandas()
            took = time.monotonic() - began
            began = time.monotonic()
            if name in ORACLES:
                found = difference(ours, con.execute(ORACLES[name]).df())
                state = "equal" if found is None else f"DIFFERS: {found}"
            else:
                found, state = None, "rows only"
            failed += found is not None
            print(f"{name:24s} {len(ours):7d} rows {took:6.2f}s sql {time.monotonic() - began:5.2f}s {state}", flush=True)
        except Exception as error:  # report every query
            failed += 1
            print(f"{name:24s} FAILED {type(error).__name__}: {str(error)[:700]}", flush=True)
    print(f"{len(names) - failed} of {len(names)} fine")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
