"""From source rows to shards and manifest, as one plan.

    python -m pairloom.pipeline --config settings.yaml [--set shard.output_dir=/data/out]
"""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.config import PipelineConfig, load_config
from pairloom.functions.layout import record_length
from pairloom.operators import ingest, manifest, ordering, shards
from pairloom.operators.process import image_size, measured, pad_id, records
from pairloom.session import local_session, ship
from pairloom.sources.readers import read_first
from pairloom.sources.shards import write_shards
from pairloom.storage import grouped, materialize, spread

log = logging.getLogger("pairloom")


def canonical_samples(rows: DataFrame, config: PipelineConfig) -> DataFrame:
    """Source rows (as they are, or already canonical) to samples; sizes of mapped images are read from their heads."""
    d = config.dataset
    if d.max_samples:
        rows = ingest.first_rows(rows, d.max_samples)
    if "image_bytes" in rows.columns and not d.column_mapping:
        return rows
    m = ingest.map_columns(rows, d.column_mapping)
    meta = F.map_filter(F.create_map(F.lit("model_reasoning"), F.col("reasoning").cast("string")), lambda k, v: F.coalesce(v.rlike(r"\S"), F.lit(False)))
    sized = m.withColumn("__size", image_size(F.col("image")))
    return sized.select(
        "row_index", ingest.sample_id(F.col("id"), F.col("row_index")).alias("sample_id"), F.col("image").alias("image_bytes"), F.col("__size.width").alias("image_width"), F.col("__size.height").alias("image_height"),
        "question", "answer", meta.alias("metadata"), F.lit(d.name).alias("dataset_name"),
    )


def ordered(keys: DataFrame, config: PipelineConfig) -> DataFrame:
    """``position`` of each row: in the order of row_index, or shuffled over all rows."""
    return ordering.global_shuffle(keys, "row_index", config.seed) if config.shuffling == "global" else ordering.sequential(keys, "row_index")


def chunked(samples: DataFrame, config: PipelineConfig) -> DataFrame:
    """(row_index, shard_id, local_index): chunks of the rows as they come, before any error is known.

    Chunks have ``max_samples_per_shard`` rows, else ``streaming_chunk_size``. Numbers
    of shards may have gaps, which the writer closes.
    """
    size = config.shard.max_samples_per_shard or config.streaming_chunk_size
    keys = ordered(samples.select("row_index"), config)
    return _inside(keys.withColumn("shard_id", F.floor(F.col("position") / F.lit(size))), config, F.col("position") - F.col("shard_id") * size)


def assigned(good: DataFrame, config: PipelineConfig) -> DataFrame:
    """(row_index, shard_id, local_index) of rows without errors, by count or by size.

    ``good`` needs row_index and for shards by size rec_len, the bytes of a record.
    """
    c = config.shard
    keys = ordered(good, config)
    if c.max_samples_per_shard:
        n = c.max_samples_per_shard
        return _inside(keys.withColumn("shard_id", F.floor(F.col("position") / F.lit(n))), config, F.col("position") - F.col("shard_id") * n)
    keys = shards.assign_by_size(keys, "rec_len", "position", c.shard_size_mb * shards.MEGABYTE)
    # Shards by size have a bounded number of records, so a task ranks a shard. Gaps, after a record longer than a shard, are closed by the writer.
    return _inside(keys, config, F.row_number().over(Window.partitionBy("shard_id").orderBy("position")) - 1)


def _inside(keys: DataFrame, config: PipelineConfig, local: Column) -> DataFrame:
    if config.shuffling == "local":
        keys = ordering.local_shuffle(keys, "shard_id", "row_index", config.seed, "local_index")
    else:
        keys = keys.withColumn("local_index", local)
    return keys.select("row_index", F.col("shard_id").cast("bigint").alias("shard_id"), F.col("local_index").cast("bigint").alias("local_index"))


def placed(samples: DataFrame, places: DataFrame) -> DataFrame:
    """Samples with their places, each shard's rows in one task and in order: the one move of the encoded images
    that writing needs."""
    return grouped(samples.join(places, "row_index"), "shard_id").sortWithinPartitions("shard_id", "local_index")


SAMPLE = ("row_index", "sample_id", "image_bytes", "question", "answer", "metadata")


def write(spark: SparkSession, valid: DataFrame, places: DataFrame, config: PipelineConfig, folder: str) -> None:
    """Move the encoded samples to the tasks of their shards; decode, tokenize and write there."""
    write_shards(ready(valid, places, config), folder, placed=True, dense=True, progress_interval=config.progress_interval, **layout_options(config))


def ready(valid: DataFrame, places: DataFrame, config: PipelineConfig, *keep: str) -> DataFrame:
    """What a shard stores of each sample, in the order in which shards store it; columns of ``places`` in ``keep`` stay."""
    r = records(placed(valid.select(*SAMPLE), places), config, ("shard_id", "local_index", *keep))
    return r.select("shard_id", "local_index", *keep, "channels", "height", "width", "orig_height", "orig_width", "image", "q_ids", "a_ids", "metadata")


def layout_options(config: PipelineConfig) -> dict[str, object]:
    """Options of the shard writer that say how records are laid out."""
    c = config.shard
    h, w = config.image.target_size if c.format_version == 1 else (config.image.max_image_dim,) * 2
    return {
        "pad_id": pad_id(config.tokenizer), "token_length": config.tokenizer.max_length, "channels": 1 if config.image.color_space == "L" else 3, "height": h, "width": w,
        "format_version": c.format_version, "compression": c.compression or "none", "alignment_bytes": c.alignment_bytes,
    }


def decodable(valid: DataFrame, config: PipelineConfig) -> DataFrame:
    """(row_index, rec_len) of the samples that can be processed: pixels are made, measured and dropped.

    Shards by count need no rec_len, and if long texts are cut no tokens either: then
    images alone are looked at, and rec_len is left out.
    """
    if config.shard.max_samples_per_shard and config.tokenizer.truncation:
        seen = measured(spread(valid.select("row_index", "image_bytes")), config.image, fail_fast=config.fail_fast)
        return materialize(seen.where("pixels.error is null").select("row_index"), "decodable")
    r = records(spread(valid.select(*SAMPLE)), config).where("error is null")
    size = F.octet_length("image") + record_length(F.lit(0), F.lit(0), F.lit(0), config.tokenizer.max_length, F.octet_length("metadata"), config.shard.format_version)
    return materialize(r.select("row_index", size.alias("rec_len")), "decodable")


def run(spark: SparkSession, config: PipelineConfig, rows: DataFrame | None = None) -> dict:
    """Write the shards and, if asked for, the manifest; returns the summary of the run.

    With ``num_workers`` 1 or more samples are chunked before errors are known, and
    images are decoded once, where they are written. With 0 shards are cut from the
    samples that can be processed, by count or by size; that takes a pass over the
    images before.
    """
    began = time.time()
    ship(spark)
    if rows is None:
        d = config.dataset
        rows = read_first(spark, [d.location(), *d.fallbacks], d.format)
    samples = canonical_samples(rows, config)
    valid = ingest.valid(samples, config.fail_fast)
    if config.num_workers:
        places = chunked(samples, config)
    else:
        places = assigned(decodable(valid, config), config)
    write(spark, valid, materialize(places, "places"), config, config.shard.output_dir)
    total = samples.count()
    m = manifest.committed(config.shard.output_dir)
    kept = m["total_samples"]
    if config.shard.manifest_path and kept:
        manifest.save(m, config.shard.manifest_path)
    took = time.time() - began
    return {"total_samples": total, "processed_samples": kept, "error_samples": total - kept, "shards_written": m["total_shards"], "total_bytes": m["total_bytes"], "elapsed_seconds": took, "samples_per_second": kept / took if took > 0 else 0.0}


def main(args: list[str] | None = None) -> int:
    """Exit code 1 if any sample was rejected."""
    p = argparse.ArgumentParser(prog="pairloom.pipeline")
    p.add_argument("--config", required=True)
    p.add_argument("--set", action="append", default=[], metavar="part.name=value")
    given = p.parse_args(args)
    over: dict = {}
    for item in given.set:
        name, _, value = item.partition("=")
        at = over
        *parts, last = name.split(".")
        for part in parts:
            at = at.setdefault(part, {})
        at[last] = int(value) if value.lstrip("-").isdigit() else value
    config = load_config(given.config, over)
    logging.basicConfig(level=config.log_level)
    spark = SparkSession.getActiveSession() or local_session()
    summary = run(spark, config)
    log.info("%s", summary)
    return int(summary["error_samples"] > 0)


if __name__ == "__main__":
    sys.exit(main())
