"""The catalog of shards: build, save, load, and deal shards to ranks."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.layout import HEADER_BYTES
from pairloom.sources.codec import body_crc, parse_header
from pairloom.sources.shards import list_shards, listing

MANIFEST_VERSION = 1


def clean_entries(entries: DataFrame) -> DataFrame:
    """One entry for each shard: repeated entries collapse, paths and checksums get lower case.

    Where repeated entries differ, the greatest values are kept.
    """
    return entries.groupBy("shard_id").agg(
        F.max(F.lower(F.trim("shard_path"))).alias("shard_path"), F.max("format_version").alias("format_version"), F.max("sample_count").alias("sample_count"), F.max("size_bytes").alias("size_bytes"), F.max(F.lower("checksum_crc32")).alias("checksum_crc32")
    )


def from_records(records: DataFrame) -> DataFrame:
    """(shard_id, samples, payload_bytes, last_byte) of each shard from its records; records written twice count once."""
    once = records.groupBy("shard_id", "local_index").agg(F.max("rec_len").alias("rec_len"), F.max(F.col("rec_offset") + F.col("rec_len")).alias("end"))
    return once.groupBy("shard_id").agg(F.count(F.lit(1)).alias("samples"), F.sum("rec_len").alias("payload_bytes"), F.max("end").alias("last_byte"))


def totals(entries: DataFrame) -> DataFrame:
    """One row: shards, samples and bytes of the cleaned entries."""
    return clean_entries(entries).agg(F.count(F.lit(1)).alias("total_shards"), F.coalesce(F.sum("sample_count"), F.lit(0)).alias("total_samples"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))


def file_entry(path: str, checksums: bool = True) -> tuple[str, int, int, int, int, str | None]:
    """(name, format version, samples, flags, bytes, checksum) of a shard file, from its bytes."""
    with open(path, "rb") as f:
        h = parse_header(f.read(HEADER_BYTES))
    return os.path.basename(path), h.version, h.sample_count, h.flags, os.path.getsize(path), f"{body_crc(path):08x}" if checksums else None


def read_shard_files(spark: SparkSession, folder: str, pattern: str = "shard_*.bin", checksums: bool = True) -> DataFrame:
    """(path, format_version, sample_count, flags, size_bytes, checksum_crc32) of shard files, from their bytes.

    The checksum is of all but the footer; tasks read the files in pieces. Raises
    FileNotFoundError for a missing folder and ValueError where no file fits.
    """
    listed = list_shards(folder.removeprefix("file://"), pattern)
    tasks = min(len(listed), max(4 * spark.sparkContext.defaultParallelism, len(listed) // 64))
    paths = spark.createDataFrame([(i, p) for i, (_, p) in enumerate(listed)], "i int, file string").repartitionById(tasks, F.pmod("i", F.lit(tasks)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([file_entry(path, checksums) for path in pdf["file"]], columns=["path", "format_version", "sample_count", "flags", "size_bytes", "checksum_crc32"])

    return paths.mapInPandas(run, "path string, format_version bigint, sample_count bigint, flags int, size_bytes bigint, checksum_crc32 string")


def build(spark: SparkSession, folder: str, pattern: str = "shard_*.bin", checksums: bool = True) -> dict:
    """Manifest of a folder as a dictionary. One small entry for each shard file reaches the driver."""
    place = {os.path.basename(p): i for i, (_, p) in enumerate(list_shards(folder.removeprefix("file://"), pattern))}
    rows = sorted(read_shard_files(spark, folder, pattern, checksums).collect(), key=lambda r: place[r.path])
    return {
        "version": MANIFEST_VERSION,
        "created_at": datetime.now(timezone.utc).isoformat(),
        "total_samples": sum(r.sample_count for r in rows),
        "total_shards": len(rows),
        "total_bytes": sum(r.size_bytes for r in rows),
        "shards": [{"path": r.path, "sample_count": r.sample_count, "size_bytes": r.size_bytes, "checksum_crc32": r.checksum_crc32 or ""} for r in rows],
    }


def committed(folder: str) -> dict:
    """Manifest of a folder as its last commit counted and summed it while writing; no shard is read.

    :func:`build` reads the files again and is the check of it. FileNotFoundError
    where nothing was committed.
    """
    said = listing(folder.removeprefix("file://"))
    if said is None:
        raise FileNotFoundError(f"{folder} has no committed shards")
    shards = [{k: x[k] for k in ("path", "sample_count", "size_bytes", "checksum_crc32")} for x in said["shards"]]
    return {
        "version": MANIFEST_VERSION,
        "created_at": datetime.now(timezone.utc).isoformat(),
        "total_samples": sum(x["sample_count"] for x in shards),
        "total_shards": len(shards),
        "total_bytes": sum(x["size_bytes"] for x in shards),
        "shards": shards,
    }


def save(manifest: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as out:
        json.dump(manifest, out, indent=2)


def load(path: str) -> dict:
    """A saved manifest; missing totals are counted from its shards."""
    with open(path, encoding="utf-8") as lines:
        m = json.load(lines)
    shards = [{"path": s["path"], "sample_count": s.get("sample_count", 0), "size_bytes": s.get("size_bytes", 0), "checksum_crc32": s.get("checksum_crc32", "")} for s in m.get("shards", [])]
    return {
        "version": m.get("version", MANIFEST_VERSION),
        "created_at": m.get("created_at", ""),
        "total_samples": m.get("total_samples", sum(s["sample_count"] for s in shards)),
        "total_shards": m.get("total_shards", len(shards)),
        "total_bytes": m.get("total_bytes", sum(s["size_bytes"] for s in shards)),
        "shards": shards,
    }


def check_rank(rank: int, world: int) -> None:
    if world <= 0:
        raise ValueError(f"world size {world} is not positive")
    if not 0 <= rank < world:
        raise ValueError(f"rank {rank} is not in 0..{world - 1}")


def deal(manifest: dict, rank: int, world: int) -> list[dict]:
    """Shards of one rank: every ``world``-th of the list."""
    check_rank(rank, world)
    return manifest["shards"][rank::world]


def deal_shards(shards: DataFrame, world: int, order: str = "shard_path") -> DataFrame:
    """``shards`` with ``rank``, dealt in turn in the order of ``order``.

    The table has one row for each shard of some hundred MB, so one task orders it.
    """
    check_rank(0, world)
    return shards.withColumn("rank", F.pmod(F.row_number().over(Window.orderBy(order, "shard_id")) - 1, F.lit(world)))
