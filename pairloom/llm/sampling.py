"""A bounded sample that is the same however the rows are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lowest_hash_rows(df: DataFrame, rows: int, seed: int, *keys: Column | str) -> DataFrame:
    """The at most ``rows`` rows of ``df`` with the lowest seeded hash of ``keys``.

    The number of rows is read first (from the file footers for a Parquet scan);
    only about three times ``rows`` candidates, over all tasks together, are then
    ordered, however many rows and tasks there are.
    """
    hashed = df.withColumn("__h", F.xxhash64(F.lit(seed), *keys))
    total = df.count()
    if total > 3 * rows:
        share = 3 * rows / total
        hashed = hashed.where(F.col("__h") < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return hashed.orderBy("__h", *df.columns).limit(rows).drop("__h")


def lowest_hashes(df: DataFrame, rows: int, seed: int, *keys: Column | str) -> list:
    """:func:`lowest_hash_rows`, at the driver."""
    return lowest_hash_rows(df, rows, seed, *keys).collect()
