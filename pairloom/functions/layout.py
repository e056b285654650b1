"""Layout of shard files as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 64
FOOTER_BYTES = 12
OFFSET_ENTRY_BYTES = 16
FLAG_UINT8, FLAG_SAMPLE_DIMS, FLAG_LZ4, FLAG_ZSTD = 1, 2, 4, 8


def aligned(size: Column, alignment: int) -> Column:
    """Size filled up to a multiple of ``alignment``."""
    return size + F.pmod(-size, F.lit(alignment))


def record_length(channels: Column, h: Column, w: Column, token_length: int, meta_bytes: Column, version: int = 2) -> Column:
    """Bytes of a packed record: sizes (format 2), pixels, four token arrays, metadata with its length."""
    pixel = 1 if version == 2 else 4
    return ((8 if version == 2 else 0) + channels.cast("bigint") * h * w * pixel + 16 * token_length + 4 + meta_bytes).cast("bigint")


def shard_path(shard_id: Column) -> Column:
    return F.format_string("shard_%04d.bin", shard_id.cast("int"))


def contiguous_rank(position: Column, total: Column, world: int) -> Column:
    """Rank that owns a position when each takes ceil(total / world) in a row."""
    return F.floor(position / F.ceil(total / F.lit(world))).cast("int")


def interleaved_rank(position: Column, world: int) -> Column:
    return F.pmod(position, F.lit(world)).cast("int")


def has_flag(flags: Column, flag: int) -> Column:
    return flags.bitwiseAND(F.lit(flag)) != 0
