"""The data source ``shard``: shard files as rows, and rows as shard files.

    read_shards(spark, folder, shard_id=3, local_index=[7, 8])
    write_shards(df, folder, token_length=128)

A shard's number is the one in its file's name. A commit leaves the file
``_shards.json`` in the folder, which has what a reader and the manifest need to know of
each shard; without it headers are read.

Options for reading: ``pattern``, ``verify_crc``, ``normalize`` (none, unit,
meanstd), ``mean``, ``std``, ``payload`` (false leaves pixels and tokens null and
reads no record), ``shard_id`` and ``local_index`` (numbers with commas; only
these shards are opened and only these records are sought), ``split`` (records for
each task). The folder must be one that executors see under the same path.

Filters are not pushed down: Spark keeps a pushed filter with the loaded source,
so that a second query of the same DataFrame would lose rows. The two options
say the same and belong to one load.
"""

from __future__ import annotations

import fnmatch
import itertools
import json
import logging
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from pairloom.sources.codec import Record, ShardFile, ShardWriter, denormalise

log = logging.getLogger("pairloom")

SCHEMA = (
    "shard_id int, local_index int, path string, channels int, height int, width int, orig_height int, orig_width int, image binary, "
    "q_ids array<int>, q_mask array<int>, a_ids array<int>, a_mask array<int>, metadata string, rec_offset bigint, rec_len bigint"
)


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in SCHEMA.split(", ")])
BATCH_BYTES, BATCH_ROWS = 32 << 20, 4096


@dataclass
class ShardRange(InputPartition):
    shard_id: int
    path: str
    first: int
    last: int
    only: tuple[int, ...] | None


@dataclass
class Written(WriterCommitMessage):
    """(shard, temporary path, samples, bytes, checksum, layout) of each file, and the rows that were left out."""

    files: list
    rejected: int = 0


#: What a commit leaves: the list of the folder's shards, and, while it is at work, what it has set out to do.
LISTING, JOURNAL = "_shards.json", "_commit.json"


def _put(path: str, value: object) -> None:
    """Write JSON under another name and rename it: there as a whole or not at all."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as out:
        json.dump(value, out)
        out.flush()
        os.fsync(out.fileno())
    os.replace(draft, path)


def recover(folder: str) -> None:
    """Finish a commit whose driver was lost; each step may be done twice."""
    try:
        with open(os.path.join(folder, JOURNAL), encoding="utf-8") as lines:
            todo = json.load(lines)
    except FileNotFoundError:
        return

    def move(pair: list[str]) -> None:
        try:
            os.replace(os.path.join(folder, pair[0]), os.path.join(folder, pair[1]))
        except FileNotFoundError:
            if not os.path.exists(os.path.join(folder, pair[1])):
                raise

    def drop(name: str) -> None:
        if os.path.exists(path := os.path.join(folder, name)):
            os.remove(path)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, todo["move"]))
        list(pool.map(drop, todo["drop"]))
    _put(os.path.join(folder, LISTING), todo["listing"])
    drop(JOURNAL)


def listing(folder: str) -> dict | None:
    """What the last commit said of the folder: ``shards`` (path, shard_id, sample_count, size_bytes,
    checksum_crc32, layout) and ``rejected``. None if there was none."""
    try:
        with open(os.path.join(folder, LISTING), encoding="utf-8") as lines:
            return json.load(lines)
    except FileNotFoundError:
        return None


def shard_number(name: str, place: int) -> int:
    """The last number in a file's name; its place in the list for names without one."""
    found = re.findall(r"\d+", name)
    return int(found[-1]) if found else place


def list_shards(folder: str, pattern: str) -> list[tuple[int, str]]:
    """(number, path) of shard files in the order of their numbers; FileNotFoundError and ValueError as for a manifest."""
    if not os.path.isdir(folder):
        raise FileNotFoundError(folder)
    recover(folder)
    names = sorted(n for n in os.listdir(folder) if fnmatch.fnmatch(n, pattern))
    if not names:
        raise ValueError(f"no file {pattern} in {folder}")
    numbered = sorted((shard_number(n, i), n) for i, n in enumerate(names))
    if len({k for k, _ in numbered}) < len(numbered):
        raise ValueError(f"two files of one number in {folder}")
    return [(k, os.path.join(folder, n)) for k, n in numbered]


def _peek(path: str) -> tuple[int, list[int]]:
    with ShardFile(path) as s:
        h = s.header
        return len(s), [h.version, h.flags & 3, h.channels, h.token_length]


def shard_counts(folder: str, pattern: str = "shard_*.bin") -> list[tuple[int, int]]:
    """(number, records) of each shard of a folder."""
    return [(i, n) for i, _, n, _ in _looked_up(folder, list_shards(folder, pattern))]


def _looked_up(folder: str, wanted: list[tuple[int, str]]) -> list[tuple[int, str, int, list[int]]]:
    """(number, path, records, layout), from the folder's listing or else from the heads of the files."""
    said = {x["path"]: (x["sample_count"], x["layout"]) for x in (listing(folder) or {}).get("shards", [])}
    unknown = [p for _, p in wanted if os.path.basename(p) not in said]
    with ThreadPoolExecutor(16) as pool:
        said |= dict(zip(map(os.path.basename, unknown), pool.map(_peek, unknown)))
    return [(i, p, *said[os.path.basename(p)]) for i, p in wanted]


class ShardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://")
        self.pattern = options.get("pattern", "shard_*.bin")
        self.verify = options.get("verify_crc", "false").lower() == "true"
        self.payload = options.get("payload", "true").lower() == "true"
        self.how = options.get("normalize", "none")
        number = lambda text: tuple(float(x) for x in text.split(","))
        self.mean, self.std = number(options.get("mean", "0.485,0.456,0.406")), number(options.get("std", "0.229,0.224,0.225"))
        self.split = int(options.get("split", "0"))
        some = lambda name: {int(x) for x in options[name].split(",") if x.strip()} if name in options else None
        self.shards, self.indices = some("shard_id"), some("local_index")
        self.trim = options.get("trim_tokens", "false").lower() == "true"

    def partitions(self) -> list[ShardRange]:
        """One task for each shard, or for each ``split`` records. Shards must agree in their layout."""
        only = None if self.indices is None else tuple(sorted(self.indices))
        wanted = _looked_up(self.folder, [(i, p) for i, p in list_shards(self.folder, self.pattern) if self.shards is None or i in self.shards])
        if len({tuple(layout) for *_, layout in wanted}) > 1:
            raise ValueError(f"shards of different layout in {self.folder}")
        out = []
        for i, path, n, _ in wanted:
            step = self.split or max(n, 1)
            out += [ShardRange(i, path, a, min(a + step, n), only) for a in range(0, n, step)]
        return out

    def read(self, part: ShardRange) -> Iterator[pa.RecordBatch]:
        """Arrow batches of at most ``BATCH_BYTES`` of pixels."""
        with ShardFile(part.path, self.verify) as s:
            rows = range(part.first, part.last) if part.only is None else [i for i in part.only if part.first <= i < part.last]
            held: list[tuple] = []
            size = 0
            for i in rows:
                held.append(self._row(s, part, i))
                size += len(held[-1][8] or b"")
                if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                    yield _batch(held)
                    held, size = [], 0
            if held:
                yield _batch(held)

    def _row(self, s: ShardFile, part: ShardRange, i: int) -> tuple:
        at, size = s.offsets[i]
        head = (part.shard_id, i, os.path.basename(part.path), s.header.channels)
        if not self.payload:
            return (*head, *[None] * 10, at, size)
        r = s[i]
        pixels = denormalise(r.pixels, self.how, self.mean, self.std)
        _, h, w = r.pixels.shape
        tokens = [r.q_ids, r.q_mask, r.a_ids, r.a_mask]
        if self.trim:
            ends = [int(np.max(np.nonzero(m)[0], initial=-1)) + 1 for m in (r.q_mask, r.a_mask)]
            tokens = [x[: ends[k // 2]] for k, x in enumerate(tokens)]
        return (*head, h, w, r.orig_height, r.orig_width, pixels.tobytes(), *tokens, r.metadata, at, size)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = []
    for values, f in zip(zip(*rows), ARROW):
        if pa.types.is_list(f.type) and values[0] is not None:
            ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values).astype(np.int32, copy=False), pa.int32())))
        else:
            columns.append(pa.array(values, f.type))
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def _tokens(batch: pa.RecordBatch, name: str, length: int, pad: int) -> np.ndarray:
    """Rows x ``length`` of a column of token arrays, filled up with ``pad``; ValueError if one is longer. Null is empty."""
    column = batch.column(name)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    if (sizes > length).any():
        raise ValueError(f"{name} must have length {length} at most in each row")
    out = np.full((len(column), length), pad, np.int32)
    out[np.arange(length) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _masks(batch: pa.RecordBatch, ids: str, mask: str, length: int) -> np.ndarray:
    """The mask column, or 1 for each token of the ids."""
    if mask in batch.schema.names:
        return _tokens(batch, mask, length, 0)
    sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
    return (np.arange(length) < sizes[:, None]).astype(np.int32)


class ShardSink(DataSourceArrowWriter):
    """Each task writes whole shards under temporary names; the driver names them when all tasks are done.

    Rows without an image are left out and counted. With ``dense`` shards are
    numbered anew, in the order of their numbers, so that shards all of whose rows
    are left out leave no gap.
    """

    def __init__(self, options: dict, names: list[str], overwrite: bool):
        self.folder = options["path"].removeprefix("file://")
        self.names, self.overwrite = names, overwrite
        self.token_length = int(options.get("token_length", "512"))
        self.channels = int(options.get("channels", "3"))
        self.side = int(options.get("max_image_dim", "384"))
        self.height, self.width = int(options.get("height", self.side)), int(options.get("width", self.side))
        self.version = int(options.get("format_version", "2"))
        self.lz4 = options.get("compression", "none").lower() == "lz4"
        self.alignment = int(options.get("alignment_bytes", "64"))
        self.pad = int(options.get("pad_id", "0"))
        self.progress = int(options.get("progress_interval", "0"))
        self.dense = options.get("dense", "false").lower() == "true"
        self.mark = f".tmp-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        done, writer, current, attempt, rejected = [], None, None, uuid.uuid4().hex[:8], 0
        kind = np.uint8 if self.version == 2 else np.dtype("<f4")

        def finish() -> None:
            if writer is not None:
                h = writer.header
                done.append((current, writer.path, *writer.close(), [h.version, h.flags & 3, h.channels, h.token_length]))

        try:
            for batch in iterator:
                plain = {c: batch.column(c).to_pylist() for c in ("shard_id", "channels", "height", "width", "orig_height", "orig_width", "metadata")}
                image = batch.column("image")
                arrays = [f(x) for x in "qa" for f in (lambda x: _tokens(batch, f"{x}_ids", self.token_length, self.pad), lambda x: _masks(batch, f"{x}_ids", f"{x}_mask", self.token_length))]
                for i, (shard, c, h, w, oh, ow, meta) in enumerate(zip(*plain.values())):
                    if not image[i].is_valid:
                        rejected += 1
                        continue
                    if shard != current:
                        finish()
                        current = shard
                        if any(current == d[0] for d in done):
                            raise ValueError("rows of a shard must follow each other; use write_shards")
                        writer = ShardWriter(os.path.join(self.folder, f"{self.mark}-{attempt}-{current}"), self.channels, self.height, self.width, self.token_length, self.version, self.lz4, self.alignment)
                    pixels = np.frombuffer(image[i].as_buffer(), kind).reshape(c, h, w)
                    if self.progress and len(writer.offsets) % self.progress == self.progress - 1:
                        log.info("shard %s: %s records", current, len(writer.offsets) + 1)
                    writer.add(Record(pixels, *(a[i] for a in arrays), meta or "{}", oh, ow))
            finish()
        except BaseException:
            if writer is not None:
                writer.abort()
            for d in done:
                os.path.exists(d[1]) and os.remove(d[1])
            raise
        return Written(done, rejected)

    def commit(self, messages: list[Written | None]) -> None:
        files = sorted(f for m in messages if m for f in m.files)
        if len({f[0] for f in files}) < len(files):
            raise ValueError("a shard was written by two tasks; use write_shards")
        os.makedirs(self.folder, exist_ok=True)
        recover(self.folder)
        former = [] if self.overwrite else (listing(self.folder) or {}).get("shards", [])
        after = 1 + max([x["shard_id"] for x in former], default=-1) if self.dense else 0
        entries, moves = {x["path"]: x for x in former}, []
        for place, (shard, path, count, size, crc, layout) in enumerate(files):
            number = after + place if self.dense else shard
            name = f"shard_{number:04d}.bin"
            moves.append([os.path.basename(path), name])
            entries[name] = {"path": name, "shard_id": number, "sample_count": count, "size_bytes": size, "checksum_crc32": crc, "layout": layout}
        drop = [n for n in os.listdir(self.folder) if fnmatch.fnmatch(n, "shard_*.bin") and n not in entries] if self.overwrite else []
        shards = sorted(entries.values(), key=lambda x: x["shard_id"])
        # From here on the new version is the one that counts: whoever comes next finishes what is begun.
        _put(os.path.join(self.folder, JOURNAL), {"move": moves, "drop": drop, "listing": {"shards": shards, "rejected": sum(m.rejected for m in messages if m)}})
        recover(self.folder)

    def abort(self, messages: list[Written | None]) -> None:
        for n in os.listdir(self.folder) if os.path.isdir(self.folder) else []:
            if n.startswith(self.mark):
                os.remove(os.path.join(self.folder, n))


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shard"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> ShardReader:
        return ShardReader(dict(self.options))

    def writer(self, schema: object, overwrite: bool) -> ShardSink:
        return ShardSink(dict(self.options), [], overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.dataSource.register(ShardSource)


def read_shards(spark: SparkSession, folder: str, shard_id: object = None, local_index: object = None, **options: object) -> DataFrame:
    """Rows of a folder's shards; ``shard_id`` and ``local_index`` are a number or several."""
    register(spark)
    reader = spark.read.format("shard")
    for name, value in {**options, "shard_id": shard_id, "local_index": local_index}.items():
        if value is not None:
            reader = reader.option(name, ",".join(map(str, value)) if isinstance(value, (list, tuple, set, range)) else str(value).lower() if isinstance(value, bool) else str(value))
    return reader.load(folder)


def write_shards(df: DataFrame, folder: str, mode: str = "overwrite", placed: bool = False, **options: object) -> None:
    """Write rows (shard_id, local_index, channels, height, width, orig_height, orig_width, image, q_ids, a_ids,
    metadata, and if there are any q_mask and a_mask) as one file for each shard.

    Token arrays may be shorter than ``token_length``. One shuffle puts a shard's rows
    into one task, in the order of local_index; ``placed`` says that they are so already.
    """
    register(df.sparkSession)
    ready = df if placed else df.repartition("shard_id").sortWithinPartitions("shard_id", "local_index")
    writer = ready.write.format("shard").mode(mode)
    for k, v in options.items():
        writer = writer.option(k, str(v).lower() if isinstance(v, bool) else str(v))
    writer.save(folder)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The rows of one shard after the other, each as batches that are taken before the next shard is asked for."""
    pieces = (batch.slice(a, b - a) for batch in batches for a, b in _borders(batch.column("shard_id").to_numpy()))
    for _, own in itertools.groupby(pieces, key=lambda piece: piece.column("shard_id")[0].as_py()):
        yield own


def _borders(shards: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def pass_shards(ready: DataFrame, folder: str, use: Callable[[str, list], Iterator[pa.RecordBatch]], schema: str, note: Callable[[pa.RecordBatch], list] | None = None, **options: object) -> DataFrame:
    """What ``use`` makes of each shard, for work that needs no two shards at once.

    ``ready`` is as for :func:`write_shards`, ``placed``. A task writes one shard as a
    whole file and commits it in a folder of its own, gives ``use`` that folder and
    what ``note`` kept of the rows, and removes it: there are as many shard files at
    a time as tasks, however many shards there are.
    """
    given = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            own, kept = os.path.join(folder, uuid.uuid4().hex), []

            def noted() -> Iterator[pa.RecordBatch]:
                for batch in rows:
                    if note is not None:
                        kept.extend(note(batch))
                    yield batch

            try:
                sink = ShardSink({**given, "path": own}, [], True)
                sink.commit([sink.write(noted())])
                yield from use(own, kept)
            finally:
                shutil.rmtree(own, ignore_errors=True)

    return ready.mapInArrow(run, schema)
