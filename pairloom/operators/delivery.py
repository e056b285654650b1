"""Batches to a training loop: ordered, numbered, resumable."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators import loader
from pairloom.operators.process import collate
from pairloom.sources.codec import Record, ShardFile, denormalise
from pairloom.sources.shards import list_shards, shard_counts
from pairloom.storage import grouped, materialize

SCHEMA = (
    "batch_id bigint, size int, channels int, height int, width int, tokens int, images binary, padding_mask binary, q_ids binary, q_mask binary, "
    "a_ids binary, a_mask binary, heights array<int>, widths array<int>, metadata array<string>"
)


#: Arrays of a collated batch.
ARRAYS = ("images", "padding_mask", "q_ids", "q_mask", "a_ids", "a_mask")


@dataclass(frozen=True)
class Checkpoint:
    """Where delivery stands."""

    seed: int
    epoch: int = 0
    next_batch: int = 0


@dataclass(frozen=True)
class LoaderConfig:
    batch_size: int = 32
    seed: int = 42
    shuffle_buffer: int | None = None
    rank: int = 0
    world_size: int = 1
    strategy: str = "contiguous"
    normalize: str = "meanstd"
    mean: tuple[float, ...] = (0.485, 0.456, 0.406)
    std: tuple[float, ...] = (0.229, 0.224, 0.225)
    batches_per_task: int = 64


def _row(group: pd.DataFrame, config: LoaderConfig) -> dict[str, object]:
    """The collated row of a batch."""
    row, b = _collated(group, config)
    return row | {k: b[k].tobytes() for k in ARRAYS} | {"metadata": b["metadata"]}


def _collated(group: pd.DataFrame, config: LoaderConfig) -> tuple[dict[str, object], dict[str, np.ndarray]]:
    """(sizes, arrays) of a batch. Pixels are moved as stored bytes; they are normalised only here."""
    how, mean, std = config.normalize, config.mean, config.std
    group = group.assign(image=[_float(i, c, h, w, how, mean, std) for i, c, h, w in zip(group["image"], group["channels"], group["height"], group["width"])])
    b = collate(group)
    n, c, h, w = b["images"].shape
    return {"batch_id": group["batch_id"].iloc[0], "size": n, "channels": c, "height": h, "width": w, "tokens": b["q_ids"].shape[1]} | {k: b[k].tolist() for k in ("heights", "widths")}, b


def collated(rows: DataFrame, config: LoaderConfig) -> DataFrame:
    """One row for each batch_id of rows that hold their records."""
    return grouped(rows, "batch_id").groupBy("batch_id").applyInPandas(lambda group: pd.DataFrame([_row(group, config)]), SCHEMA)


def measured(rows: DataFrame, config: LoaderConfig) -> DataFrame:
    """The sizes of what :func:`collated` makes of each batch, and the bytes of its arrays (``images_len`` and so on).

    Batches are put together as there; their arrays do not leave the task. Of the
    records, pixels are moved as stored bytes.
    """
    fields = "batch_id bigint, size int, channels int, height int, width int, tokens int, heights array<int>, widths array<int>, " + ", ".join(f"{k}_len bigint" for k in ARRAYS)
    names = ["batch_id", "position", "image", "channels", "height", "width", "q_ids", "q_mask", "a_ids", "a_mask", "metadata"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def summary(group: pd.DataFrame) -> dict[str, object]:
            row, b = _collated(group, config)
            return row | {f"{k}_len": b[k].nbytes for k in ARRAYS}

        held: list[pd.DataFrame] = []
        for pdf in batches:
            groups = [g for _, g in pdf.groupby("batch_id", sort=False)]
            out = []
            for group in groups:
                if held and held[0]["batch_id"].iloc[0] != group["batch_id"].iloc[0]:
                    out.append(summary(pd.concat(held)))
                    held = []
                held.append(group)
            if out:
                yield pd.DataFrame(out)
        if held:
            yield pd.DataFrame([summary(pd.concat(held))])

    return grouped(rows.select(*names), "batch_id").sortWithinPartitions("batch_id", "position").mapInPandas(run, fields)


def collated_from(folder: str, plan: DataFrame, config: LoaderConfig, pattern: str = "shard_*.bin") -> DataFrame:
    """One row for each batch of ``plan`` (batch_id, position, shard_id, local_index).

    Each batch's rows must follow each other in one task. Records are sought in the
    shard files where a batch is collated: pixels are never shuffled.
    """
    paths = plan.sparkSession.sparkContext.broadcast(dict(list_shards(folder, pattern)))  # a name for each shard of some hundred MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: OrderedDict[int, ShardFile] = OrderedDict()
        held: list[tuple] = []

        def record(shard: int, index: int) -> Record:
            if shard not in opened:
                if len(opened) >= 256:
                    opened.popitem(last=False)[1].close()
                opened[shard] = ShardFile(paths.value[shard])
            opened.move_to_end(shard)
            return opened[shard][index]

        def finished() -> pd.DataFrame:
            group = []
            for batch_id, position, shard, index in held:
                r = record(shard, index)
                c, h, w = r.pixels.shape
                group.append((batch_id, position, r.pixels.tobytes(), c, h, w, r.q_ids, r.q_mask, r.a_ids, r.a_mask, r.metadata))
            held.clear()
            return pd.DataFrame([_row(pd.DataFrame(group, columns=["batch_id", "position", "image", "channels", "height", "width", "q_ids", "q_mask", "a_ids", "a_mask", "metadata"]), config)])

        try:
            for pdf in batches:
                for row in pdf[["batch_id", "position", "shard_id", "local_index"]].itertuples(index=False, name=None):
                    if held and held[0][0] != row[0]:
                        yield finished()
                    held.append(row)
            if held:
                yield finished()
        finally:
            for f in opened.values():
                f.close()

    return plan.select("batch_id", "position", "shard_id", "local_index").mapInPandas(run, SCHEMA)


def _float(image: bytes, c: int, h: int, w: int, how: str, mean: tuple, std: tuple) -> bytes:
    if len(image) == c * h * w:
        return denormalise(np.frombuffer(image, np.uint8).reshape(c, h, w), how, mean, std).astype(np.float32).tobytes()
    return image


def to_numpy(row) -> dict[str, object]:
    """Arrays of a collated row."""
    n, c, h, w, t = row["size"], row["channels"], row["height"], row["width"], row["tokens"]
    out: dict[str, object] = {"batch_id": row["batch_id"], "images": np.frombuffer(row["images"], np.float32).reshape(n, c, h, w), "padding_mask": np.frombuffer(row["padding_mask"], np.float32).reshape(n, h, w)}
    for k in ("q_ids", "q_mask", "a_ids", "a_mask"):
        out[k] = np.frombuffer(row[k], np.int32).reshape(n, t)
    return out | {"heights": list(row["heights"]), "widths": list(row["widths"]), "metadata": list(row["metadata"])}


def to_torch(batch: dict[str, object], device: str = "cpu") -> dict[str, object]:
    """The same with tensors, where torch is installed; arrays otherwise."""
    try:
        import torch
    except ImportError:
        return batch
    return {k: torch.from_numpy(v.copy()).to(device) if isinstance(v, np.ndarray) else v for k, v in batch.items()}


class BatchLoader:
    """Gives out the batches of one rank and epoch in the order of their numbers.

    ``records`` is a DataFrame with shard_id, local_index and the columns of shard
    rows, or the folder of the shards (with ``spark``). The order is planned on these
    two columns only. From a folder, tasks seek the records of their batches in the
    files; the rows of a DataFrame join the plan.

    Either iterate, or ask :meth:`has_next` and :meth:`next`; both go on from the
    checkpoint. :meth:`stop` ends what runs.
    """

    def __init__(self, records: DataFrame | str, config: LoaderConfig | None = None, checkpoint: Checkpoint | None = None, spark: SparkSession | None = None):
        self.records, self.config = records, config or LoaderConfig()
        loader.check_partition(self.config.rank, self.config.world_size, self.config.strategy)
        self.checkpoint = checkpoint or Checkpoint(self.config.seed)
        if isinstance(records, str):
            self.spark = spark or SparkSession.active()
            self.records = records = records.removeprefix("file://")
            self.addresses, self.total = self._listed(records)
        else:
            self.spark = records.sparkSession
            addresses = loader.address_table(records.select("shard_id", "local_index", F.lit(0).cast("bigint").alias("row_index"))).drop("row_index")
            self.addresses = materialize(addresses, "addresses")
            self.total = self.addresses.count()
        self._running: Iterator | None = None
        self._tag = f"pairloom-loader-{id(self)}"

    def _listed(self, folder: str) -> tuple[DataFrame, int]:
        """(global_index, shard_id, local_index) of the folder's records, from the counts of its shards."""
        counts = shard_counts(folder)
        starts, total = [], 0
        for shard, n in counts:
            starts.append((shard, n, total))
            total += n
        each = self.spark.createDataFrame([x for x in starts if x[1]], "shard_id int, n bigint, start bigint").repartition(self.spark.sparkContext.defaultParallelism)
        rows = each.select("shard_id", "start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"))
        return rows.select((F.col("start") + F.col("i")).alias("global_index"), "shard_id", F.col("i").cast("int").alias("local_index")), total

    def plan(self) -> DataFrame:
        """(shard_id, local_index, position, batch_id) of this rank's rows in this epoch."""
        c = self.config
        mine = loader.with_rank(self.addresses, "global_index", F.lit(max(self.total, 1)), c.world_size, c.strategy).where(F.col("rank") == c.rank)
        return loader.epoch_batches(mine, "global_index", self.checkpoint.seed, self.checkpoint.epoch, c.batch_size, c.shuffle_buffer).select("shard_id", "local_index", "position", "batch_id")

    def __len__(self) -> int:
        """Batches of an epoch."""
        mine = len(loader.worker_indices(self.total, self.config.rank, self.config.world_size, self.config.strategy))
        return -(-mine // self.config.batch_size)

    def placed(self) -> DataFrame:
        """The plan of the batches that are left: whole batches in each task, tasks and rows in their order."""
        first = self.checkpoint.next_batch
        count = max(len(self) - first, 1)
        tasks = max(1, min(count, max(self.spark.sparkContext.defaultParallelism, -(-count // self.config.batches_per_task))))
        task = F.floor((F.col("batch_id") - first) * tasks / F.lit(count)).cast("int")
        return loader.resume(self.plan(), first).repartitionById(tasks, task).sortWithinPartitions("batch_id", "position")

    def batches(self) -> DataFrame:
        """The batches that are left, as rows."""
        if isinstance(self.records, str):
            return collated_from(self.records, self.placed(), self.config)
        return collated(self.records.join(loader.resume(self.plan(), self.checkpoint.next_batch), ["shard_id", "local_index"]), self.config)

    def _rows(self) -> Iterator:
        self.spark.addTag(self._tag)
        try:
            # From a folder the tasks are in the order of their batches already.
            ready = self.batches() if isinstance(self.records, str) else self.batches().orderBy("batch_id")
            yield from ready.toLocalIterator(prefetchPartitions=True)
        finally:
            self.spark.removeTag(self._tag)

    def has_next(self) -> bool:
        return self.checkpoint.next_batch < len(self)

    def next(self) -> dict[str, object]:
        """The next batch; RuntimeError after the last one."""
        if not self.has_next():
            raise RuntimeError("the epoch has no more batches; reset() begins the next one")
        if self._running is None:
            self._running = self._rows()
        row = next(self._running)
        self.checkpoint = replace(self.checkpoint, next_batch=row["batch_id"] + 1)
        return to_numpy(row)

    def next_torch(self, device: str = "cpu") -> dict[str, object]:
        """The next batch as tensors, where torch is installed."""
        return to_torch(self.next(), device)

    def __iter__(self) -> BatchLoader:
        return self

    def __next__(self) -> dict[str, object]:
        if not self.has_next():
            self.stop()
            raise StopIteration
        return self.next()

    def stop(self) -> None:
        """End the jobs of this loader; it can go on from its checkpoint."""
        if self._running is not None:
            self._running.close()
            self._running = None
            self.spark.interruptTag(self._tag)

    def reset(self) -> None:
        """On to the next epoch."""
        self.stop()
        self.checkpoint = Checkpoint(self.checkpoint.seed, self.checkpoint.epoch + 1)
