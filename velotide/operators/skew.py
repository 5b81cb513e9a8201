"""Left join of a frame with arbitrary key frequencies to a keyed table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most keys ever treated as hot, and how many a task's sketch follows.  A key
# that holds more than about 0.2 percent of the rows cannot be overlooked.
HOT_KEYS = 256
_FOLLOWED = 2048


def _keyless(keys: list[str]) -> Column:
    return reduce(or_, [F.col(key).isNull() for key in keys])


def _code(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def _key_use(rows: DataFrame, keys: list[str]) -> tuple[list[int], int]:
    """Codes of hot keys and the number of rows without a key, in one pass."""
    sketch = f"approx_top_k(_code, {HOT_KEYS}, {_FOLLOWED})"
    codes = rows.select(F.when(~_keyless(keys), _code(keys)).alias("_code"))
    found = codes.agg(F.expr(f"{sketch} FILTER (WHERE _code IS NOT NULL)").alias("top"), F.count(F.lit(1)).alias("all"),
                      F.count_if(F.col("_code").isNull()).alias("keyless")).first()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A key is hot if its rows alone are more than an average partition's.
    return [e["item"] for e in found["top"] or [] if e["count"] * partitions > found["all"]], found["keyless"]


def hot_key_codes(rows: DataFrame, keys: list[str]) -> list[int]:
    """Codes of keys with more rows than an average shuffle partition, at most ``HOT_KEYS``.

    An action: one pass over the keys with a frequent-items sketch, whose size
    does not depend on the number of rows or keys.
    """
    return _key_use(rows, keys)[0]


def left_join_hot_keys(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows LEFT JOIN table USING (keys)`` for a ``table`` unique on ``keys``.

    Rows of hot keys are joined by broadcast with the few table rows they need
    and are not shuffled; the others are shuffled on the keys.  Every row takes
    exactly one of the two ways, whichever keys are found hot, so the result is
    that of the plain join.  Without hot keys and rows without a key it is the
    plain join.  Looking for them is an action on ``rows``.
    """
    codes, without_key = _key_use(rows, keys)
    if not codes and not without_key:
        return rows.join(table, keys, "left")
    # A row without a key matches nothing; it need not be shuffled either.
    keyless = _keyless(keys)
    hot = _code(keys).isin(codes)
    wanted = table.where(hot & ~keyless)
    on_hot = rows.where(hot | keyless).join(F.broadcast(wanted), keys, "left")
    on_rest = rows.where(~hot & ~keyless).join(table, keys, "left")
    return on_hot.unionByName(on_rest)
