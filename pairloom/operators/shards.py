"""Which shard a sample goes to, and where its record lies there."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.layout import HEADER_BYTES, aligned
from pairloom.operators.ordering import sequential, with_position

MEGABYTE = 1024 * 1024


def assign_before_errors(positioned: DataFrame, size: int, ok: Column, position: str = "position") -> DataFrame:
    """Chunks of ``size`` input rows; bad rows are dropped afterwards; chunks that keep rows are numbered densely.

    Adds shard_id and local_index. Only the chunk numbers (one for ``size`` rows)
    are ranked over all.
    """
    kept = positioned.withColumn("chunk", F.floor(F.col(position) / F.lit(size))).where(ok)
    chunks = with_position(kept.select("chunk").distinct(), F.floor(F.col("chunk") / F.lit(65536)), [F.col("chunk")], "shard_id")
    local = Window.partitionBy("chunk").orderBy(position)
    return kept.join(chunks, "chunk").withColumn("local_index", F.row_number().over(local) - 1).drop("chunk")


def assign_after_errors(survivors: DataFrame, id_col: str, size: int | None) -> DataFrame:
    """Chunks of ``size`` surviving rows in id order; ``None`` puts all into one shard."""
    numbered = sequential(survivors, id_col)
    if size is None:
        return numbered.withColumn("shard_id", F.lit(0).cast("bigint")).withColumn("local_index", F.col("position"))
    return numbered.withColumn("shard_id", F.floor(F.col("position") / F.lit(size))).withColumn("local_index", F.pmod("position", F.lit(size)))


def running_total(df: DataFrame, value: str, id_col: str, width: int = 65536, name: str = "before") -> DataFrame:
    """Sum of ``value`` over all rows of smaller id, without a task that sees all rows. Ids are unique; null values count as 0."""
    v = F.coalesce(F.col(value), F.lit(0))
    keyed = df.withColumn("__b", F.floor(F.col(id_col) / F.lit(width)))
    totals = keyed.groupBy("__b").agg(F.sum(v).alias("__t"))
    earlier = F.sum("__t").over(Window.orderBy(F.asc_nulls_first("__b")).rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("__b").alias("__ob"), F.coalesce(earlier, F.lit(0)).alias("__o"))
    inside = F.sum(v).over(Window.partitionBy("__b").orderBy(F.asc_nulls_first(id_col)).rowsBetween(Window.unboundedPreceding, -1))
    ranked = keyed.withColumn("__i", F.coalesce(inside, F.lit(0)))
    return ranked.join(offsets, F.col("__b").eqNullSafe(F.col("__ob"))).withColumn(name, F.col("__o") + F.col("__i")).drop("__b", "__ob", "__o", "__i")


def assign_by_size(df: DataFrame, size_col: str, id_col: str, limit_bytes: int) -> DataFrame:
    """Shard by the bytes that come before: a shard starts every ``limit_bytes``. Deterministic and parallel."""
    return running_total(df, size_col, id_col).withColumn("shard_id", F.floor(F.col("before") / F.lit(limit_bytes))).drop("before")


def rotate_by_size(df: DataFrame, group: str, size_col: str, id_col: str, limit_bytes: int, most: int | None = None) -> DataFrame:
    """Greedy rotation inside each ``group``: a new shard once the current one has reached ``limit_bytes``
    bytes or ``most`` samples. (group, id, local_shard). Groups are writer tasks of bounded size; only ids and sizes move."""
    gtype, itype = df.schema[group].dataType.simpleString(), df.schema[id_col].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id_col, kind="stable")
        shard = filled = count = 0
        shards = []
        for size in pdf[size_col].fillna(0):
            if count and (filled >= limit_bytes or (most and count >= most)):
                shard, filled, count = shard + 1, 0, 0
            shards.append(shard)
            filled, count = filled + size, count + 1
        return pd.DataFrame({group: pdf[group], id_col: pdf[id_col], "local_shard": shards})

    return df.select(group, id_col, size_col).groupBy(group).applyInPandas(run, f"`{group}` {gtype}, `{id_col}` {itype}, local_shard int")


def offset_table(records: DataFrame, length: str = "rec_len", alignment: int = 64) -> DataFrame:
    """Adds rec_offset: header, then each record at a multiple of ``alignment`` (shards have a bounded size)."""
    w = Window.partitionBy("shard_id").orderBy("local_index").rowsBetween(Window.unboundedPreceding, -1)
    start = HEADER_BYTES + (-HEADER_BYTES) % alignment
    return records.withColumn("rec_offset", F.lit(start) + F.coalesce(F.sum(aligned(F.col(length), alignment)).over(w), F.lit(0)))


def run_summary(samples: DataFrame, errors: str = "errors", per_shard: int = 100) -> DataFrame:
    """One row: samples seen, kept and rejected, share rejected, shards needed."""
    bad = F.count_if(F.size(errors) > 0)
    return samples.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size(errors) == 0).alias("processed"), bad.alias("error_samples")).select(
        "total", "processed", "error_samples", F.ceil(F.col("processed") / F.lit(per_shard)).cast("bigint").alias("shards")
    )
