"""Source rows as they arrive: a file stream that writes one set of shards for each micro-batch."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pairloom.config import PipelineConfig


def arrivals(spark: SparkSession, folder: str, schema: StructType, files: int = 64) -> DataFrame:
    """Stream of a folder's Parquet files, ``files`` at most in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str = "14 days") -> DataFrame:
    """Repeated deliveries that come within ``late`` count once; state older than that is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def arrival_counts(stream: DataFrame, at: str, window: str = "1 day", late: str | None = "14 days") -> DataFrame:
    """(window start, rows) of arrivals; rows later than ``late`` are left out. None: the stream has its watermark already."""
    return (stream.withWatermark(at, late) if late else stream).groupBy(F.window(at, window).alias("w")).agg(F.count(F.lit(1)).alias("rows")).select(F.col("w.start").alias("start"), "rows")


def shard_sink(stream: DataFrame, config: PipelineConfig, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch as shards into its own folder, ``batch-<n>``, all data that is there now.

    A batch that is repeated after a failure overwrites its folder, so rows are written once.
    """
    from dataclasses import replace

    from pairloom.pipeline import run

    base = config.shard.output_dir

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            run(batch.sparkSession, replace(config, shard=replace(config.shard, output_dir=os.path.join(base, f"batch-{number:06d}"))), batch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
