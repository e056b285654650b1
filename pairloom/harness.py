"""Timed runs of the pipeline and the loader: writers of fixed and of per-sample sizes, both ways of chunking,
several numbers of samples, and batches from shards against batches from the encoded images."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import ImageConfig, PipelineConfig, ShardConfig, TokenizerConfig
from pairloom.operators import delivery, loader
from pairloom.operators.process import decoded
from pairloom.pipeline import run
from pairloom.storage import grouped


@dataclass(frozen=True)
class Timing:
    """One timed run. ``unit_ms`` has the time of each batch, where batches were timed."""

    label: str
    samples: int
    seconds: float
    bytes: int = 0
    shards: int = 0
    errors: int = 0
    unit_ms: tuple[float, ...] = ()

    @property
    def per_second(self) -> float:
        return self.samples / self.seconds if self.seconds > 0 else 0.0


@dataclass
class Timings:
    """Runs in the order in which they were made."""

    runs: list[Timing] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(label, samples, seconds, bytes, shards, errors, unit_ms, per_second), for the operators of metrics."""
        schema = "label string, samples bigint, seconds double, bytes bigint, shards int, errors bigint, unit_ms array<double>, per_second double"
        return spark.createDataFrame([(*asdict(r).values(), r.per_second) for r in self.runs], schema)


def scaling_sizes(total: int, wanted: Iterable[int] = (250, 500, 1000, 2000)) -> list[int]:
    """The wanted numbers of samples that there are, and all of them, in order."""
    return sorted({n for n in wanted if 0 < n < total} | {total})


def settings(folder: str, workers: int = 4, fixed: bool = False, per_shard: int = 200, side: int = 384, tokens: int = 512) -> PipelineConfig:
    """Settings of a timed run: ``fixed`` writes normalised images of one size (format 1), else bytes of each sample's size (format 2)."""
    image = ImageConfig(target_size=(side, side), max_image_dim=side, storage_dtype="float32" if fixed else "uint8", dynamic_padding=not fixed)
    return PipelineConfig(num_workers=workers, image=image, tokenizer=TokenizerConfig(max_length=tokens), shard=ShardConfig(output_dir=folder, max_samples_per_shard=per_shard, format_version=1 if fixed else 2))


def time_writing(spark: SparkSession, samples: DataFrame, config: PipelineConfig, label: str) -> Timing:
    """Samples to shards."""
    s = run(spark, config, samples)
    return Timing(label, s["processed_samples"], s["elapsed_seconds"], s["total_bytes"], s["shards_written"], s["error_samples"])


def _time_batches(batches: Iterator, most: int, warmup: int, size: Callable[[object], tuple[int, int]], label: str) -> Timing:
    """Time of up to ``most`` batches, after ``warmup`` ones that are not counted."""
    samples = held = 0
    millis = []
    for place in range(most + warmup):
        began = time.perf_counter()
        batch = next(batches, None)
        if batch is None:
            break
        if place >= warmup:
            millis.append(1000 * (time.perf_counter() - began))
            n, b = size(batch)
            samples, held = samples + n, held + b
    return Timing(label, samples, sum(millis) / 1000, held, unit_ms=tuple(millis))


def time_loading(spark: SparkSession, folder: str, batch_size: int = 16, batches: int = 40, warmup: int = 3, label: str = "loader") -> Timing:
    """Batches of an epoch from shards."""
    made = delivery.BatchLoader(folder, delivery.LoaderConfig(batch_size=batch_size), spark=spark)
    try:
        return _time_batches(iter(made), batches, warmup, lambda b: (len(b["images"]), b["images"].nbytes + sum(b[k].nbytes for k in ("q_ids", "q_mask", "a_ids", "a_mask"))), label)
    finally:
        made.stop()


def time_naive_loading(samples: DataFrame, config: PipelineConfig, batch_size: int = 16, batches: int = 40, warmup: int = 3, label: str = "naive") -> Timing:
    """Batches that decode and resize the encoded images each time, without tokens."""
    placed = loader.epoch_batches(samples.select("row_index"), "row_index", config.seed, 0, batch_size, buffer=0)
    rows = decoded(samples.select("row_index", "image_bytes").join(placed, "row_index"), config.image).where("pixels.error is null").select("batch_id", "pixels.image")

    def collate(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch_id": group["batch_id"].iloc[:1], "size": [len(group)], "images": [b"".join(group["image"])]})

    made = grouped(rows, "batch_id").groupBy("batch_id").applyInPandas(collate, "batch_id bigint, size int, images binary")
    return _time_batches(made.toLocalIterator(), batches, warmup, lambda r: (r["size"], len(r["images"])), label)


def compare(spark: SparkSession, samples: DataFrame, folder: str, sizes: Iterable[int] | None = None, **options: int) -> Timings:
    """All of the above: both writers, both ways of chunking at each number of samples, both loaders."""
    out = Timings()
    total = samples.count()
    for n in sizes if sizes is not None else scaling_sizes(total):
        some = samples.orderBy("row_index").limit(n)
        for label, workers in (("after errors", 0), ("before errors", 4)):
            out.runs.append(time_writing(spark, some, settings(f"{folder}/{label.replace(' ', '-')}-{n}", workers, **options), f"{label} {n}"))
    for label, fixed in (("fixed", True), ("per sample", False)):
        config = settings(f"{folder}/{label.replace(' ', '-')}", fixed=fixed, **options)
        out.runs.append(time_writing(spark, samples, config, f"{label} sizes"))
        out.runs.append(time_loading(spark, config.shard.output_dir, label=f"loader, {label} sizes"))
    out.runs.append(time_naive_loading(samples.where(F.length("image_bytes") > 0), settings(folder, fixed=True, **options)))
    return out
