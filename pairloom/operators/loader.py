"""Epoch order, partitions over ranks, batches, padding and resuming.

Everything is decided on narrow keys; pixels are moved once, when a batch is
collated. Each batch has a number, so delivery order and resuming are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.layout import contiguous_rank, interleaved_rank
from pairloom.functions.text import last_set
from pairloom.operators.ordering import block_shuffle, global_shuffle, sequential

STRATEGIES = ("contiguous", "interleaved")


def check_partition(worker: int, workers: int, strategy: str) -> None:
    if workers <= 0 or not 0 <= worker < workers:
        raise ValueError(f"worker {worker} of {workers}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is not one of {STRATEGIES}")


def worker_indices(total: int, worker: int, workers: int, strategy: str = "contiguous") -> range:
    """Positions that a worker owns; late workers may own none."""
    check_partition(worker, workers, strategy)
    if strategy == "interleaved":
        return range(worker, total, workers)
    chunk = -(-total // workers)
    return range(min(worker * chunk, total), min((worker + 1) * chunk, total))


def address_table(records: DataFrame) -> DataFrame:
    """(global_index, shard_id, local_index, row_index) in shard order, then record order.

    Records written twice count once (the lowest row). The index is the prefix sum
    of the shards' counts, a small table, plus the place in the shard.
    """
    once = records.groupBy("shard_id", "local_index").agg(F.min("row_index").alias("row_index"))
    counts = once.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("shard_id").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard_id", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard_id").orderBy("local_index")) - 1
    return once.withColumn("place", place).join(starts, "shard_id").select((F.col("start") + F.col("place")).alias("global_index"), "shard_id", "local_index", "row_index")


def with_rank(df: DataFrame, index: str, total: Column, world: int, strategy: str = "contiguous") -> DataFrame:
    check_partition(0, world, strategy)
    rank = contiguous_rank(F.col(index), total, world) if strategy == "contiguous" else interleaved_rank(F.col(index), world)
    return df.withColumn("rank", rank)


def partition_faults(df: DataFrame, index: str, total: int) -> DataFrame:
    """(fault, index): indices owned twice, missing or out of range. Empty if the partition is right."""
    owned = df.groupBy(index).agg(F.count(F.lit(1)).alias("n"))
    twice = owned.where("n > 1").select(F.lit("twice").alias("fault"), F.col(index).alias("index"))
    outside = owned.where((F.col(index) < 0) | (F.col(index) >= total) | F.col(index).isNull()).select(F.lit("outside").alias("fault"), F.col(index).alias("index"))
    all_ = df.sparkSession.range(total).withColumnRenamed("id", index)
    missing = all_.join(owned, index, "left_anti").select(F.lit("missing").alias("fault"), F.col(index).alias("index"))
    return twice.unionByName(outside).unionByName(missing)


def epoch_batches(df: DataFrame, id_col: str, seed: int, epoch: int, batch_size: int, buffer: int | None = None) -> DataFrame:
    """``df`` with position and batch_id of an epoch; the last batch may be smaller.

    ``buffer`` None shuffles all rows, 0 keeps the id's order, another number
    shuffles blocks of that many rows.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be 1 at least")
    if buffer is None:
        ordered = global_shuffle(df, id_col, seed + epoch)
    else:
        ordered = sequential(df, id_col)
        if buffer > 1:
            ordered = block_shuffle(ordered, "position", buffer, id_col, seed + epoch, "shuffled").drop("position").withColumnRenamed("shuffled", "position")
    return ordered.withColumn("batch_id", F.floor(F.col("position") / F.lit(batch_size)))


def resume(batches: DataFrame, next_batch: int) -> DataFrame:
    """Batches that were not delivered yet."""
    return batches.where(F.col("batch_id") >= next_batch)


def bucket_batches(df: DataFrame, bucket: str, id_col: str, batch_size: int) -> DataFrame:
    """Batches inside each aspect bucket in id order. Buckets are few and hot, so places are counted in id ranges."""
    width = 65536
    keyed = df.withColumn("__b", F.floor(F.col(id_col) / F.lit(width)))
    counts = keyed.groupBy(bucket, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(bucket).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(bucket, "__b", F.coalesce(before, F.lit(0)).alias("__o"))
    place = F.row_number().over(Window.partitionBy(bucket, "__b").orderBy(id_col)) - 1
    return keyed.withColumn("__p", place).join(starts, [bucket, "__b"]).withColumn("bucket_batch", F.floor((F.col("__o") + F.col("__p")) / F.lit(batch_size))).drop("__b", "__p", "__o")


def padded_dims(batched: DataFrame, width: str, height: str, q_len: str, a_len: str) -> DataFrame:
    """(batch_id, batch_size, max_h, max_w, max_t, real_pixels, padded_pixels) of each batch."""
    t = F.greatest(F.lit(1), F.max(F.greatest(F.coalesce(q_len, F.lit(0)), F.coalesce(a_len, F.lit(0)))))
    per = batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"), F.max(height).alias("max_h"), F.max(width).alias("max_w"), t.alias("max_t"), F.sum(F.col(height).cast("bigint") * F.col(width)).alias("real_pixels")
    )
    return per.withColumn("padded_pixels", F.col("batch_size") * F.col("max_h").cast("bigint") * F.col("max_w"))


def token_trim(batched: DataFrame, q_mask: str, a_mask: str) -> DataFrame:
    """(batch_id, tokens_kept): tokens up to the last one set in any mask of the batch, 1 at least."""
    return trim_of_lengths(batched.select("batch_id", last_set(F.col(q_mask)).alias("q"), last_set(F.col(a_mask)).alias("a")), "q", "a")


def trim_of_lengths(batched: DataFrame, q: str, a: str) -> DataFrame:
    """The same from each row's places of the last tokens, so that no mask needs to be moved."""
    return batched.groupBy("batch_id").agg(F.greatest(F.lit(1), F.max(F.greatest(q, a))).alias("tokens_kept"))
