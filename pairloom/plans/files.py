"""Queries that write and read files, decode images or run a stream. SQL can say only some of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import ImageConfig, PipelineConfig, ShardConfig
from pairloom.functions import layout
from pairloom.operators import delivery, ingest, manifest, ordering, process, shards
from pairloom.pipeline import SAMPLE, assigned, decodable, layout_options, placed, ready, write
from pairloom.plans.ingest import _TOK, _VALID
from pairloom.plans.layout_sql import WHOLE_PNG
from pairloom.sources.shards import SCHEMA, ShardReader, list_shards, listing, pass_shards
from pairloom.storage import materialize, new_path, spread
from pairloom.streaming.arrivals import arrivals
from pairloom.tables import table


def _shared(spark: SparkSession, name: str) -> str:
    """A folder that executors see under the same path."""
    return new_path(spark, name).removeprefix("file://").removeprefix("file:")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid(table(spark, sf_dir, "samples"))


def image_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which images can be decoded, their true sizes, and whether the table's sizes are right."""
    s = table(spark, sf_dir, "samples").select("row_index", "image_bytes", "image_width", "image_height")
    d = process.decoded(spread(s), ImageConfig(max_image_dim=4096))
    return d.select("row_index", F.col("pixels.error").isNull().alias("decodes"), "pixels.orig_width", "pixels.orig_height", ((F.col("pixels.orig_width") == F.col("image_width")) & (F.col("pixels.orig_height") == F.col("image_height"))).alias("sizes_right"))


def image_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised images of one size: what lies in each, and that padding is where geometry puts it."""
    c = ImageConfig(storage_dtype="float32", dynamic_padding=False)
    d = process.measured(spread(table(spark, sf_dir, "samples").select("row_index", "image_bytes")), c)
    return d.select("row_index", "pixels.channels", "pixels.height", "pixels.width", "pixels.image_len")


def _planned(spark: SparkSession, sf_dir: str, compression: str | None, shuffling: str = "none") -> tuple[DataFrame, DataFrame, PipelineConfig]:
    """(samples, places of those that can be processed in shards of 1000 records, settings)."""
    c = PipelineConfig(shuffling=shuffling, num_workers=0, shard=ShardConfig(max_samples_per_shard=1000, compression=compression))
    valid = _samples(spark, sf_dir)
    return valid, materialize(assigned(decodable(valid, c), c), "places"), c


def _written(spark: SparkSession, sf_dir: str, compression: str | None, shuffling: str = "none") -> tuple[str, DataFrame, PipelineConfig]:
    """(folder of shards of 1000 records that can be processed, the samples where they were written, settings)."""
    valid, places, c = _planned(spark, sf_dir, compression, shuffling)
    folder = _shared(spark, "shards")
    write(spark, valid, places, c, folder)
    return folder, placed(valid.select(*SAMPLE), places), c


def _prints(batch: pa.RecordBatch, tokens: list[np.ndarray]) -> list[tuple[int, int, bytes]]:
    """(shard, place, fingerprint of all that is stored) of each row; ``tokens`` are q_ids, q_mask, a_ids and a_mask."""
    out = []
    plain = [batch.column(x).to_pylist() for x in ("shard_id", "local_index", "image", "channels", "height", "width", "orig_height", "orig_width", "metadata")]
    for i, (shard, place, image, *rest) in enumerate(zip(*plain)):
        h = hashlib.sha1(repr(rest).encode(), usedforsecurity=False)
        h.update(image or b"")
        for x in tokens:
            h.update(x[i])
        out.append((shard, place, h.digest()))
    return out


def _round_trip(spark: SparkSession, sf_dir: str, compression: str | None) -> DataFrame:
    """Records that come back equal and records that do not (none), whole: pixels, tokens with their padding, masks."""
    valid, places, c = _planned(spark, sf_dir, compression)
    n = c.tokenizer.max_length

    def given(batch: pa.RecordBatch) -> list[tuple[int, int, bytes]]:
        tokens = []
        for column in (batch.column("q_ids"), batch.column("a_ids")):
            ids, mask = np.zeros((2, len(batch), n), np.int32)
            values, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
            for i in range(len(batch)):
                own = values[ends[i] : ends[i + 1]][:n]
                ids[i, : len(own)], mask[i, : len(own)] = own, 1
            tokens += [ids, mask]
        return _prints(batch, tokens)

    def compared(folder: str, kept: list) -> Iterator[pa.RecordBatch]:
        reader, back = ShardReader({"path": folder, "verify_crc": "true"}), set()
        for part in reader.partitions() if (listing(folder) or {}).get("shards") else []:
            for batch in reader.read(part):
                back.update(_prints(batch, [batch.column(x).flatten().to_numpy().reshape(-1, n) for x in ("q_ids", "q_mask", "a_ids", "a_mask")]))
        equal = len(back.intersection(kept))
        places = {x[:2] for x in kept} | {x[:2] for x in back}
        yield pa.RecordBatch.from_pylist([{"shard_id": kept[0][0], "equal": equal, "different": len(places) - equal}], pa.schema({"shard_id": pa.int64(), "equal": pa.int64(), "different": pa.int64()}))

    return pass_shards(ready(valid, places, c), _shared(spark, "shards"), compared, "shard_id bigint, equal bigint, different bigint", given, **layout_options(c))


def shard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, None)


def lz4_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "lz4")


def shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries of written shards, from their bytes, and whether the writer's own count, size and checksum agree."""
    valid, places, c = _planned(spark, sf_dir, None, "local")

    def audited(folder: str, _: list) -> Iterator[pa.RecordBatch]:
        said = {x["path"]: (x["sample_count"], x["size_bytes"], x["checksum_crc32"]) for x in manifest.committed(folder)["shards"]}
        for _, path in list_shards(folder, "shard_*.bin"):
            name, version, count, _, size, crc = manifest.file_entry(path)
            yield pa.RecordBatch.from_pylist([{"path": name, "format_version": version, "sample_count": count, "agrees": said.get(name) == (count, size, crc)}])

    return pass_shards(ready(valid, places, c), _shared(spark, "shards"), audited, "path string, format_version bigint, sample_count bigint, agrees boolean", **layout_options(c))


def shard_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the heads of compressed shards say of their records."""
    folder, _, _ = _written(spark, sf_dir, "lz4")
    f = F.col("flags")
    kinds = {"uint8": layout.FLAG_UINT8, "sample_dims": layout.FLAG_SAMPLE_DIMS, "lz4": layout.FLAG_LZ4, "zstd": layout.FLAG_ZSTD}
    return manifest.read_shard_files(spark, folder, checksums=False).select("path", *[layout.has_flag(f, v).alias(k) for k, v in kinds.items()])


def shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some records of each shard, sought through the offset table."""
    valid, places, c = _planned(spark, sf_dir, None)

    def sought(folder: str, _: list) -> Iterator[pa.RecordBatch]:
        reader = ShardReader({"path": folder, "local_index": "0,7,99"})
        for part in reader.partitions():
            yield from reader.read(part)

    found = pass_shards(ready(valid, places, c), _shared(spark, "shards"), sought, SCHEMA, **layout_options(c))
    return found.select("shard_id", "local_index", F.get_json_object("metadata", "$.sample_id").alias("sample_id"), "height", "width", (F.col("rec_offset") % 64 == 0).alias("aligned"), F.aggregate("a_mask", F.lit(0), lambda x, y: x + y).alias("answer_tokens"))


def collate_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, normalised batches of an epoch: sizes, real pixels, tokens."""
    valid, places, c = _planned(spark, sf_dir, None)
    how = delivery.LoaderConfig(batch_size=32)
    # Records go to their batches as they come back from their shard, so that no two shards are needed at once.
    plan = delivery.BatchLoader(places.select("shard_id", "local_index"), how).plan()
    planned = places.join(plan, ["shard_id", "local_index"])

    def known(batch: pa.RecordBatch) -> list[tuple[int, tuple[int, int]]]:
        return list(zip(batch.column("local_index").to_pylist(), zip(batch.column("batch_id").to_pylist(), batch.column("position").to_pylist())))

    def back(folder: str, kept: list) -> Iterator[pa.RecordBatch]:
        reader, at = ShardReader({"path": folder, "trim_tokens": "true"}), dict(kept)
        for part in reader.partitions():
            for batch in reader.read(part):
                ids, positions = zip(*(at[i] for i in batch.column("local_index").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(positions, pa.int64()), *batch.columns], names=["batch_id", "position", *batch.schema.names])

    rows = pass_shards(ready(valid, planned, c, "batch_id", "position"), _shared(spark, "shards"), back, f"batch_id bigint, position bigint, {SCHEMA}", known, **layout_options(c))
    b = delivery.measured(rows, how)
    area = F.aggregate(F.zip_with("heights", "widths", lambda h, w: h.cast("bigint") * w), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return b.select("batch_id", "size", "height", "width", "tokens", area.alias("real_pixels"), (F.col("images_len") == 12 * F.col("size") * F.col("height") * F.col("width")).alias("whole"))


def shuffle_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Displacement of a streaming buffer of 1024 rows in each group of orders: rows, places used, and rows given out too early."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(8)).alias("part"))
    moved = ordering.shuffle_buffer(o, 1024, 42, "part", "o_orderkey")
    return moved.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("out_pos").alias("places"), F.count_if(F.col("out_pos") < F.col("in_pos") - 1023).alias("early"), (F.max("out_pos") + 1).alias("end"))


def rotate_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy rotation inside groups of a hundred shards' records."""
    r = table(spark, sf_dir, "shard_records").groupBy("row_index").agg(F.max("rec_len").alias("rec_len"), F.floor(F.min("shard_id") / 100).alias("g"))
    return shards.rotate_by_size(r, "g", "rec_len", "row_index", 65536, 64).withColumnRenamed("g", "writer")


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and kind, counted by a stream that reads all there is and ends."""
    source = f"{sf_dir}/events.parquet"
    out, checkpoint = new_path(spark, "stream-out"), new_path(spark, "stream-checkpoint")
    stream = arrivals(spark, f"{sf_dir}/events[.]parquet", spark.read.parquet(source).schema)  # a pattern: the table may be one file
    counts = stream.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")
    write = lambda batch, _: batch.write.mode("overwrite").parquet(out)  # noqa: E731 - complete mode: each batch has all
    counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(out).select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


QUERIES = [image_decode, image_fit, shard_roundtrip, lz4_roundtrip, shard_files, shard_flags, shard_lookup, collate_dynamic, shuffle_buffer, rotate_by_size, stream_counts]

# Sizes stand at fixed places of a PNG.
_HEX = "hex(coalesce(image_bytes, ''::BLOB))"
_WHOLE = WHOLE_PNG
_W, _H = (f"CASE WHEN {_WHOLE} THEN CAST('0x' || substr({_HEX}, {at}, 8) AS INTEGER) END" for at in (33, 41))
_SEQ = f"(SELECT *, row_number() OVER (ORDER BY row_index) - 1 AS p FROM (SELECT row_index, sample_id, question, answer, {_W} AS w, {_H} AS h FROM samples WHERE {_VALID} AND {_WHOLE}))"
_ROUND = f"SELECT CAST(floor(p / 1000) AS BIGINT) AS shard_id, count(*) AS equal, CAST(0 AS BIGINT) AS different FROM {_SEQ} GROUP BY 1"
_LEN_Q, _LEN_A = (f"len({_TOK.format(c=c)})" for c in ("question", "answer"))
_EPOCH0 = f"(SELECT *, CAST(floor((row_number() OVER (ORDER BY md5('42:0:' || p), p) - 1) / 32) AS BIGINT) AS batch_id FROM {_SEQ})"
_PER_WRITER = "(SELECT writer, row_index, rec_len, row_number() OVER (PARTITION BY writer ORDER BY row_index) AS i FROM (SELECT row_index, max(rec_len) AS rec_len, CAST(floor(min(shard_id) / 100) AS BIGINT) AS writer FROM shard_records GROUP BY row_index))"

ORACLES = {
    "stream_counts": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "image_decode": f"SELECT row_index, {_WHOLE} AS decodes, {_W} AS orig_width, {_H} AS orig_height, {_W} = image_width AND {_H} = image_height AS sizes_right FROM samples",
    "image_fit": f"SELECT row_index, CASE WHEN {_WHOLE} THEN 3 END AS channels, CASE WHEN {_WHOLE} THEN 384 END AS height, CASE WHEN {_WHOLE} THEN 384 END AS width, CASE WHEN {_WHOLE} THEN 3 * 384 * 384 * 4 END AS image_len FROM samples",
    "shard_roundtrip": _ROUND,
    "lz4_roundtrip": _ROUND,
    "shard_files": f"SELECT printf('shard_%04d.bin', shard_id) AS path, CAST(2 AS BIGINT) AS format_version, CAST(equal AS BIGINT) AS sample_count, true AS agrees FROM ({_ROUND})",
    "shard_flags": f"SELECT printf('shard_%04d.bin', shard_id) AS path, true AS uint8, true AS sample_dims, true AS lz4, false AS zstd FROM ({_ROUND})",
    "shard_lookup": f"SELECT CAST(floor(p / 1000) AS INTEGER) AS shard_id, CAST(p % 1000 AS INTEGER) AS local_index, sample_id, h AS height, w AS width, true AS aligned, CAST(least({_LEN_A}, 512) AS INTEGER) AS answer_tokens FROM {_SEQ} WHERE p % 1000 IN (0, 7, 99)",
    "collate_dynamic": f"SELECT batch_id, CAST(count(*) AS INTEGER) AS size, max(h) AS height, max(w) AS width, CAST(greatest(1, max(greatest(least({_LEN_Q}, 512), least({_LEN_A}, 512)))) AS INTEGER) AS tokens, CAST(sum(CAST(h AS BIGINT) * w) AS BIGINT) AS real_pixels, true AS whole FROM {_EPOCH0} GROUP BY batch_id",
    "shuffle_buffer": "SELECT o_orderkey % 8 AS part, count(*) AS rows, count(*) AS places, CAST(0 AS BIGINT) AS early, count(*) AS \"end\" FROM orders GROUP BY 1",
    # A new shard once the one before is full: a sum that starts again, row by row.
    "rotate_by_size": f"WITH RECURSIVE r AS MATERIALIZED {_PER_WRITER}, g AS (SELECT writer, i, row_index, 0 AS local_shard, rec_len AS filled, 1 AS n FROM r WHERE i = 1 UNION ALL SELECT r.writer, r.i, r.row_index, g.local_shard + CASE WHEN g.filled >= 65536 OR g.n >= 64 THEN 1 ELSE 0 END, CASE WHEN g.filled >= 65536 OR g.n >= 64 THEN r.rec_len ELSE g.filled + r.rec_len END, CASE WHEN g.filled >= 65536 OR g.n >= 64 THEN 1 ELSE g.n + 1 END FROM g JOIN r ON r.writer = g.writer AND r.i = g.i + 1) SELECT writer, row_index, local_shard FROM g",
}
