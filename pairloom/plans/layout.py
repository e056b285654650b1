"""Queries of geometry, ordering, shard layout, manifest and loader operators."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import ImageConfig, TokenizerConfig
from pairloom.functions import geometry, layout
from pairloom.functions.text import has_text, last_set, mask, token_ids
from pairloom.operators import ingest, loader, manifest, ordering, process, shards
from pairloom.storage import grouped, materialize
from pairloom.tables import table

SEED, EPOCH, BATCH, WORLD, BLOCK, BUCKETS = 42, 3, 32, 4, 1024, 6
TARGET, LONGEST = 384, 384
TOKENS = TokenizerConfig().max_length


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image sizes from 64 to 4096 for every order, so that production targets scale them."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("id"), (64 + F.pmod(k * 7919, F.lit(4033))).cast("int").alias("w"), (64 + F.pmod(k * 104729, F.lit(4033))).cast("int").alias("h"))


def sample_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "samples").select("row_index", F.col("image_width").alias("w"), F.col("image_height").alias("h"))


def valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of valid samples, written once: the checks read the image bytes, and a position needs its rows twice."""
    return materialize(ingest.valid(table(spark, sf_dir, "samples")).select("row_index"), "valid-ids")


def resize_and_pad_geometry(spark, sf_dir):
    return dims(spark, sf_dir).select("id", *[v.alias(k) for k, v in geometry.resize_and_pad(F.col("w"), F.col("h"), TARGET, TARGET).items()])


def center_crop_geometry(spark, sf_dir):
    return dims(spark, sf_dir).select("id", *[v.alias(k) for k, v in geometry.center_crop(F.col("w"), F.col("h"), TARGET, TARGET).items()])


def resize_preserve_geometry(spark, sf_dir):
    return dims(spark, sf_dir).select("id", *[v.alias(k) for k, v in geometry.preserve_aspect(F.col("w"), F.col("h"), LONGEST).items()])


def sample_geometry(spark, sf_dir):
    """Samples' own sizes, with null, zero and negative ones."""
    return sample_dims(spark, sf_dir).select("row_index", *[v.alias(k) for k, v in geometry.preserve_aspect(F.col("w"), F.col("h"), 20).items()])


def ar_bucket(spark, sf_dir):
    return dims(spark, sf_dir).select("id", geometry.aspect_bucket(F.col("w"), F.col("h"), BUCKETS).alias("bucket_id"))


def ar_bucket_batches(spark, sf_dir):
    b = ar_bucket(spark, sf_dir)
    return loader.bucket_batches(b, "bucket_id", "id", BATCH).select("id", "bucket_id", "bucket_batch")


def bucket_histogram(spark, sf_dir):
    b = sample_dims(spark, sf_dir).where("w > 0 and h > 0").select(geometry.aspect_bucket(F.col("w"), F.col("h"), BUCKETS).alias("bucket_id"))
    return b.groupBy("bucket_id").agg(F.count(F.lit(1)).alias("samples"))


def deferred_normalize(spark, sf_dir):
    q = F.least(F.lit(255), F.greatest(F.lit(0), F.floor((F.col("x").cast("double") + 1) * 127.5)))
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return e.select("vec_id", "pos", q.cast("int").alias("pixel"), F.round(geometry.normalise(q.cast("double"), 0.485, 0.229), 4).alias("value"))


def global_shuffle(spark, sf_dir):
    return ordering.global_shuffle(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SEED)


def epoch_shuffle(spark, sf_dir):
    return ordering.global_shuffle(table(spark, sf_dir, "samples").select("row_index"), "row_index", SEED + EPOCH)


def local_shuffle(spark, sf_dir):
    r = table(spark, sf_dir, "shard_records").select("shard_id", "row_index").distinct()
    return ordering.local_shuffle(r, "shard_id", "row_index", SEED)


def block_shuffle(spark, sf_dir):
    s = ordering.sequential(table(spark, sf_dir, "samples").select("row_index"), "row_index")
    return ordering.block_shuffle(s, "position", BLOCK, "row_index", SEED)


def shard_assign_streaming(spark, sf_dir):
    checked = materialize(ingest.with_errors(table(spark, sf_dir, "samples")).select("row_index", (F.size("errors") == 0).alias("ok")), "checked-ids")
    return shards.assign_before_errors(ordering.sequential(checked, "row_index"), 100, F.col("ok")).select("row_index", "shard_id", "local_index")


def shard_assign_compact(spark, sf_dir):
    return shards.assign_after_errors(valid_ids(spark, sf_dir), "row_index", 100).select("row_index", "shard_id", "local_index")


def shard_assign_by_size(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    return shards.assign_by_size(d, "bytes", "doc_id", 65536).select("doc_id", "shard_id")


def shard_path(spark, sf_dir):
    return table(spark, sf_dir, "shards").select("shard_id", layout.shard_path(F.col("shard_id")).alias("path")).distinct()


def record_length(spark, sf_dir):
    m = F.coalesce(F.octet_length(F.element_at("metadata", "model_reasoning")), F.lit(0))
    s = table(spark, sf_dir, "samples").where("image_width >= 1 and image_height >= 1")
    n = layout.record_length(F.lit(3), F.col("image_height"), F.col("image_width"), 128, m)
    return s.select("row_index", n.alias("rec_len"), layout.aligned(n, 64).alias("aligned_len"), layout.record_length(F.lit(3), F.lit(TARGET), F.lit(TARGET), 128, m, version=1).alias("v1_len"))


def offset_table(spark, sf_dir):
    r = table(spark, sf_dir, "shard_records").groupBy("shard_id", "local_index").agg(F.max("rec_len").alias("rec_len"))
    return shards.offset_table(r).select("shard_id", "local_index", "rec_len", "rec_offset")


def offset_faults(spark, sf_dir):
    """Shards by the number of records whose stored place is not what the lengths give."""
    r = table(spark, sf_dir, "shard_records").groupBy("shard_id", "local_index").agg(F.max("rec_len").alias("rec_len"), F.max("rec_offset").alias("stored"))
    o = shards.offset_table(r)
    return o.groupBy("shard_id").agg(F.count_if(F.col("stored") != F.col("rec_offset")).alias("differing"), F.count(F.lit(1)).alias("records"))


def run_summary(spark, sf_dir):
    return shards.run_summary(ingest.with_errors(table(spark, sf_dir, "samples")))


def manifest_shards(spark, sf_dir):
    return manifest.clean_entries(table(spark, sf_dir, "shards"))


def manifest_totals(spark, sf_dir):
    return manifest.totals(table(spark, sf_dir, "shards"))


def manifest_check(spark, sf_dir):
    """Entries against the records: samples that the entry counts, and that are there."""
    m = manifest.clean_entries(table(spark, sf_dir, "shards")).select("shard_id", "sample_count")
    r = manifest.from_records(table(spark, sf_dir, "shard_records"))
    return m.join(r, "shard_id", "full_outer").select("shard_id", "sample_count", "samples", "payload_bytes", (F.col("sample_count") - F.col("samples")).alias("off_by"))


def manifest_rollup(spark, sf_dir):
    """Samples and bytes of each rank, and of all."""
    e = manifest.deal_shards(manifest.clean_entries(table(spark, sf_dir, "shards")), WORLD)
    return e.rollup("rank").agg(F.sum("sample_count").alias("samples"), F.sum("size_bytes").alias("bytes"), F.count(F.lit(1)).alias("shards")).withColumn("rank", F.coalesce("rank", F.lit(-1)))


def assign_shards_rr(spark, sf_dir):
    return manifest.deal_shards(manifest.clean_entries(table(spark, sf_dir, "shards")), WORLD).select("shard_path", "rank")


def rank_load(spark, sf_dir):
    e = manifest.deal_shards(manifest.clean_entries(table(spark, sf_dir, "shards")), WORLD)
    return e.groupBy("rank").agg(F.count(F.lit(1)).alias("shards"), F.sum("sample_count").alias("samples"))


def rank_overlap(spark, sf_dir):
    """Shards of more than one rank: none."""
    e = manifest.deal_shards(manifest.clean_entries(table(spark, sf_dir, "shards")), WORLD)
    return e.groupBy("shard_id").agg(F.countDistinct("rank").alias("ranks")).groupBy("ranks").agg(F.count(F.lit(1)).alias("shards"))


def address_table(spark, sf_dir):
    return loader.address_table(table(spark, sf_dir, "shard_records"))


def _addressed(spark, sf_dir):
    return materialize(loader.address_table(table(spark, sf_dir, "shard_records")), "addresses")


def partition_contiguous(spark, sf_dir):
    a = _addressed(spark, sf_dir)
    return loader.with_rank(a.select("global_index", "shard_id"), "global_index", F.lit(a.count()), WORLD, "contiguous")


def partition_interleaved(spark, sf_dir):
    a = loader.address_table(table(spark, sf_dir, "shard_records"))
    return loader.with_rank(a.select("global_index", "shard_id"), "global_index", F.lit(0), WORLD, "interleaved")


def verify_partition(spark, sf_dir):
    """Faults of the address table as a partition (none), and how many indices were looked at."""
    a = _addressed(spark, sf_dir)
    n = a.count()
    faults = loader.partition_faults(a, "global_index", n).agg(F.count(F.lit(1)).alias("faults"))
    return faults.withColumn("indices", F.lit(n))


def epoch_batches(spark, sf_dir):
    e = loader.epoch_batches(valid_ids(spark, sf_dir), "row_index", SEED, EPOCH, BATCH)
    return loader.with_rank(e, "position", F.lit(0), WORLD, "interleaved").select("row_index", "position", "batch_id", "rank")


def checkpoint_resume(spark, sf_dir):
    return loader.resume(loader.epoch_batches(valid_ids(spark, sf_dir), "row_index", SEED, EPOCH, BATCH), 100).select("row_index", "batch_id")


def point_lookup(spark, sf_dir):
    """Record 7 of every shard, wherever it lies."""
    r = table(spark, sf_dir, "shard_records").where("local_index = 7")
    return r.groupBy("shard_id").agg(F.min("row_index").alias("row_index"), F.max("rec_len").alias("rec_len"))


def batch_by_indices(spark, sf_dir):
    wanted = spark.createDataFrame([(i,) for i in (3, 14, 15, 92, 65)], "local_index int")
    return table(spark, sf_dir, "shard_records").join(F.broadcast(wanted), "local_index", "left_semi").select("shard_id", "local_index", "row_index").distinct()


def flag_bits(spark, sf_dir):
    """Flag tests over all values of two bytes' low half, from the shards' numbers."""
    f = F.pmod(F.col("shard_id"), F.lit(16)).cast("int")
    return table(spark, sf_dir, "shards").select("shard_id", f.alias("flags")).distinct().select(
        "shard_id",
        layout.has_flag(F.col("flags"), layout.FLAG_UINT8).alias("uint8"),
        layout.has_flag(F.col("flags"), layout.FLAG_SAMPLE_DIMS).alias("sample_dims"),
        layout.has_flag(F.col("flags"), layout.FLAG_LZ4).alias("lz4"),
        layout.has_flag(F.col("flags"), layout.FLAG_ZSTD).alias("zstd"),
    )


def _batched_records(spark, sf_dir):
    r = table(spark, sf_dir, "shard_records").groupBy("row_index").agg(*[F.max(c).alias(c) for c in ("actual_width", "actual_height", "q_len", "a_len")])
    return loader.epoch_batches(r, "row_index", SEED, EPOCH, BATCH)


def batch_pad_dims(spark, sf_dir):
    return loader.padded_dims(_batched_records(spark, sf_dir), "actual_width", "actual_height", "q_len", "a_len").select("batch_id", "batch_size", "max_h", "max_w", "max_t")


def padding_waste(spark, sf_dir):
    p = loader.padded_dims(_batched_records(spark, sf_dir), "actual_width", "actual_height", "q_len", "a_len")
    return p.select("batch_id", F.round(1 - F.col("real_pixels") / F.col("padded_pixels"), 6).alias("waste"))


def batch_token_trim(spark, sf_dir):
    s = table(spark, sf_dir, "samples").where(has_text(F.col("question")) & has_text(F.col("answer")))
    m = s.select("row_index", last_set(mask(token_ids(F.col("question")), TOKENS)).alias("q"), last_set(mask(token_ids(F.col("answer")), TOKENS)).alias("a"))
    return loader.trim_of_lengths(loader.epoch_batches(m, "row_index", SEED, EPOCH, BATCH), "q", "a")


def collate_fixed(spark, sf_dir):
    return collated_fixed(table(spark, sf_dir, "samples"))


def _numbers(rows: np.ndarray, sizes: list[int]) -> str:
    """The numbers of all rows with commas between them; beyond its size a row has zeros."""
    zeros = ",0" * rows.shape[1]
    return ",".join(",".join(map(str, row[:n].tolist())) + zeros[2 * n :] if n else zeros[1:] for row, n in zip(rows, sizes))


def collated_fixed(samples: DataFrame, checksum: bool = False) -> DataFrame:
    """Token arrays and pixels of each batch side by side, in the order of positions: checksums of the tokens, and
    how many images and bytes of pixels were put together, and with ``checksum`` that of the pixels.

    Pixels are moved as stored bytes, and brought to one size where a batch is
    collated; an image that cannot be decoded is 0 there and does not count as one.
    """
    s = samples.select("row_index", "image_bytes", token_ids(F.col("question")).alias("q"), token_ids(F.col("answer")).alias("a"))
    b = s.join(loader.epoch_batches(s.select("row_index"), "row_index", SEED, EPOCH, BATCH), "row_index")
    c = ImageConfig(storage_dtype="float32", dynamic_padding=False)

    kept: dict[str, np.ndarray] = {}  # a task's own: fresh arrays for each batch cost more, in page faults, than what is written into them

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position", kind="stable")
        row: dict[str, object] = {"batch_id": group["batch_id"].iloc[0], "batch_size": len(group)}
        for name in "qa":
            ids, mask_ = np.zeros((2, len(group), TOKENS), np.int32)
            sizes = []
            for i, tokens in enumerate(group[name]):
                n = min(len(tokens), TOKENS)
                ids[i, :n], mask_[i, :n] = tokens[:n], 1
                sizes.append(n)
            for kind, values in (("ids", ids), ("mask", mask_)):
                row[f"{name}_{kind}_md5"] = hashlib.md5(_numbers(values, sizes).encode()).hexdigest()
        if len(group) > len(kept.get("pixels", ())):
            kept["pixels"] = np.empty((len(group), 3, *c.target_size), np.float32)
        pixels, decoded, first, good = kept["pixels"][: len(group)], 0, {}, {}
        for i, x in enumerate(group["image_bytes"]):
            if (same := first.setdefault(x, i)) < i:
                pixels[i] = pixels[same]
                decoded += good[same]
                continue
            error = process.image_into(pixels[i], x, c)[-1]
            if error is not None:
                pixels[i] = 0
            good[i] = error is None
            decoded += good[i]
        row |= {"images": decoded, "pixel_bytes": pixels.nbytes}
        return pd.DataFrame([row | ({"pixels_md5": hashlib.md5(pixels).hexdigest()} if checksum else {})])

    schema = "batch_id bigint, batch_size bigint, q_ids_md5 string, q_mask_md5 string, a_ids_md5 string, a_mask_md5 string, images bigint, pixel_bytes bigint" + (", pixels_md5 string" if checksum else "")
    return grouped(b.select("batch_id", "position", "image_bytes", "q", "a"), "batch_id").groupBy("batch_id").applyInPandas(run, schema)


QUERIES = [
    resize_and_pad_geometry, center_crop_geometry, resize_preserve_geometry, sample_geometry, ar_bucket, ar_bucket_batches, bucket_histogram, deferred_normalize, global_shuffle, epoch_shuffle, local_shuffle, block_shuffle,
    shard_assign_streaming, shard_assign_compact, shard_assign_by_size, shard_path, record_length, offset_table, offset_faults, run_summary, manifest_shards, manifest_totals, manifest_check, manifest_rollup, assign_shards_rr, rank_load, rank_overlap,
    address_table, partition_contiguous, partition_interleaved, verify_partition, epoch_batches, checkpoint_resume, point_lookup, batch_by_indices, flag_bits, batch_pad_dims, padding_waste, batch_token_trim, collate_fixed,
]
