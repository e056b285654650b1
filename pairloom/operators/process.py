"""Samples to processed records: pixels in Arrow batches, tokens in column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from pairloom.config import ImageConfig, PipelineConfig, TokenizerConfig
from pairloom.functions import pixels as px
from pairloom.functions.text import token_ids

_SIZES = ("channels", "height", "width", "orig_height", "orig_width")
PIXELS = StructType([StructField("image", BinaryType()), *[StructField(c, IntegerType()) for c in _SIZES], StructField("error", StringType())])
_ARROW = [pa.field("image", pa.binary()), *[pa.field(c, pa.int32()) for c in _SIZES], pa.field("error", pa.string())]
#: Pixels that a task holds before it hands them on.
BATCH_BYTES = 32 << 20


def image_record(data: bytes | None, c: ImageConfig) -> tuple:
    """(bytes, channels, height, width, original height, original width, error) of an encoded image."""
    try:
        rgb = px.decode(data)
        oh, ow = rgb.shape[:2]
        shown = px.colour(rgb, c.color_space)
        if c.storage_dtype == "uint8":
            out = px.preserved(shown, c.max_image_dim, c.interpolation)
        else:
            out = px.normalised(px.fit(shown, *c.target_size, c.resize_strategy, c.interpolation, c.pad_value), c.normalization_mean, c.normalization_std)
        return (out.tobytes(), *out.shape, oh, ow, None)
    except ValueError as why:
        return (None, None, None, None, None, None, str(why))


#: Bytes of images and of what was made of them that a task remembers.
MEMORY_BYTES = 32 << 20


def remembered(make: Callable[[bytes | None], tuple]) -> Callable[[bytes | None], tuple]:
    """``make``, which is not called again for an image of the same bytes while it is remembered."""
    known: dict[bytes | None, tuple] = {}
    size = 0

    def look(data: bytes | None) -> tuple:
        nonlocal size
        if (row := known.get(data)) is None:
            row = make(data)
            size += 300 + len(data or b"") + sum(len(x) for x in row if isinstance(x, bytes))
            if size > MEMORY_BYTES:
                known.clear()
                size = 0
            else:
                known[data] = row
        return row

    return look


def measured(df: DataFrame, config: ImageConfig, image: str = "image_bytes", fail_fast: bool = False) -> DataFrame:
    """``df`` without its images, with the column ``pixels``: what :func:`decoded` makes, but for the image its length
    in bytes, ``image_len``. Pixels are made as there, and do not leave the task."""
    names = [c for c in df.columns if c != image]
    fields = [pa.field("image_len", pa.int32()), *_ARROW[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = np.empty((1 if config.color_space == "L" else 3, *config.target_size), np.float32) if config.storage_dtype != "uint8" else None

        def make(data: bytes | None) -> tuple:
            if fixed is not None:
                return image_into(fixed, data, config)
            made, *rest = image_record(data, config)
            return (None if made is None else len(made), *rest)

        look = remembered(make)
        for batch in batches:
            rows = [look(x) for x in batch.column(image).to_pylist()]
            if fail_fast and (why := next((r[-1] for r in rows if r[-1]), None)):
                raise ValueError(why)
            made = pa.StructArray.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], fields=fields)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), made], names=[*names, "pixels"])

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in names), StructField("pixels", StructType([StructField("image_len", IntegerType()), *PIXELS.fields[1:]]))]))


def image_into(out: np.ndarray, data: bytes | None, c: ImageConfig) -> tuple:
    """(bytes, channels, height, width, original height, original width, error) of an encoded image whose pixels of one
    size, those of :func:`image_record`, are written into ``out``. After an error ``out`` is as it was."""
    try:
        rgb = px.decode(data)
        px.fit_normalised(out, px.colour(rgb, c.color_space), c.resize_strategy, c.interpolation, c.pad_value, c.normalization_mean, c.normalization_std)
        return (out.nbytes, *out.shape, *rgb.shape[:2], None)
    except ValueError as why:
        return (None, None, None, None, None, None, str(why))


def decoded(df: DataFrame, config: ImageConfig, image: str = "image_bytes", fail_fast: bool = False) -> DataFrame:
    """``df`` with the column ``pixels`` (image, sizes, error), in the order of its rows.

    Images that cannot be decoded have an error and null pixels; ``fail_fast`` raises
    instead. Decoded images are far larger than their files, so they leave in batches
    of at most ``BATCH_BYTES`` (or one image), whatever the size of the batches that come.
    """
    at = df.columns.index(image)
    names = [*df.columns, "pixels"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = remembered(lambda data: image_record(data, config))
        for batch in batches:
            start, held, size = 0, [], 0

            def piece() -> pa.RecordBatch:
                part = batch.slice(start, len(held))
                made = pa.StructArray.from_arrays([pa.array(values, f.type) for values, f in zip(zip(*held), _ARROW)], fields=_ARROW)
                return pa.RecordBatch.from_arrays([*part.columns, made], names=names)

            for value in batch.column(at):
                row = look(value.as_py())
                if fail_fast and row[-1]:
                    raise ValueError(row[-1])
                held.append(row)
                size += len(row[0] or b"")
                if size >= BATCH_BYTES:
                    yield piece()
                    start, held, size = start + len(held), [], 0
            if held:
                yield piece()

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("pixels", PIXELS)]))


def image_size(image: Column) -> Column:
    """(width, height) as an image's head says; null for heads that are not understood. PNG heads are read in the JVM,
    only other images go to Python."""
    number = lambda at: F.conv(F.hex(F.substring(image, at, 4)), 16, 10).cast("int")
    png = F.coalesce(F.hex(F.substring(image, 1, 8)) == px.PNG_MARK.hex().upper(), F.lit(False)) & (F.octet_length(image) >= 24)
    sizes = lambda batch: pd.DataFrame([px.head_size(x) for x in batch], columns=["width", "height"]).astype("Int32")
    return F.when(png, F.struct(number(17).alias("width"), number(21).alias("height"))).otherwise(F.pandas_udf(sizes, "width int, height int")(F.when(~png, image)))


@lru_cache(maxsize=4)
def _loaded(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


#: Names of padding tokens, then of end tokens that stand in for them.
PAD_NAMES = ("[PAD]", "<pad>", "<|pad|>", "</s>", "<|endoftext|>", "<eos>", "[SEP]")


def pad_id(config: TokenizerConfig) -> int:
    """Id of the padding token, else of the end token, else 0."""
    if config.name == "hash":
        return 0
    t = _loaded(f"{config.folder}/{config.name}")
    return next((i for i in map(t.token_to_id, PAD_NAMES) if i is not None), 0)


def ids_of(text: Column, config: TokenizerConfig) -> Column:
    """Token ids of a text, without padding: 'hash' is the built-in tokenizer in column expressions, which has no
    special tokens, another name a file of the folder. Texts that spell a special token's name are plain text."""
    if config.name == "hash":
        return token_ids(text)
    path, special = f"{config.folder}/{config.name}", config.add_special_tokens

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _loaded(path)
        t.encode_special_tokens = True
        for batch in batches:
            yield pd.Series([e.ids for e in t.encode_batch([x or "" for x in batch], add_special_tokens=special)])

    return F.pandas_udf(run, "array<int>")(text)


def decode_ids(ids: list[int], config: TokenizerConfig, skip_special: bool = True) -> str:
    """Text of token ids by a tokenizer file."""
    if config.name == "hash":
        raise ValueError("the built-in tokenizer has no vocabulary of its own; join the ids with one")
    return _loaded(f"{config.folder}/{config.name}").decode(ids, skip_special_tokens=skip_special)


def enriched(given: Column, **known: Column) -> Column:
    """JSON of a metadata map with what is known of the sample; known names win over given ones."""
    own = F.to_json(F.struct(*[v.alias(k) for k, v in known.items()]))
    rest = F.map_filter(F.coalesce(given, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*known))
    return F.when(F.size(rest) == 0, own).otherwise(F.concat(F.regexp_replace(F.to_json(rest), r"\}$", ","), F.substr(own, F.lit(2))))


def records(samples: DataFrame, config: PipelineConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """Samples with pixels, token ids without padding, their lengths and metadata JSON; ``error`` says why a row has
    no image. Rows stay where they are and in their order. Columns of ``keep`` stay too."""
    t = config.tokenizer
    n = t.max_length
    with_ids = decoded(samples, config.image, fail_fast=config.fail_fast).withColumns({"q": ids_of(F.col("question"), t), "a": ids_of(F.col("answer"), t)})
    known = {"sample_id": F.col("sample_id"), "original_width": F.col("pixels.orig_width"), "original_height": F.col("pixels.orig_height")}
    if t.dynamic_text_padding:
        known |= {"actual_question_length": F.least(F.size("q"), F.lit(n)), "actual_answer_length": F.least(F.size("a"), F.lit(n))}
    long = F.lit(False) if t.truncation else F.greatest(F.size("q"), F.size("a")) > n
    why = F.concat(F.lit("sample "), F.coalesce(F.col("sample_id"), F.lit("null")), F.lit(f": more than {n} tokens"))
    if config.fail_fast and not t.truncation:
        why = F.raise_error(why).cast("string")
    error = F.coalesce(F.col("pixels.error"), F.when(long, why))
    image = F.when(error.isNull(), F.col("pixels.image"))
    sizes = [F.col(f"pixels.{c}") for c in ("channels", "height", "width", "orig_height", "orig_width")]
    return with_ids.select(
        "row_index", *keep, "sample_id", image.alias("image"), *sizes, error.alias("error"), F.slice("q", 1, n).alias("q_ids"), F.slice("a", 1, n).alias("a_ids"),
        F.least(F.size("q"), F.lit(n)).alias("q_len"), F.least(F.size("a"), F.lit(n)).alias("a_len"), enriched(F.col("metadata"), **known).alias("metadata"),
    )


def collate(group: pd.DataFrame) -> dict[str, np.ndarray]:
    """Arrays of one batch: images padded to the largest, mask, token arrays cut to the last token, metadata."""
    group = group.sort_values("position", kind="stable")
    images = [np.frombuffer(i, np.float32 if len(i) == 4 * c * h * w else np.uint8).reshape(c, h, w) for i, c, h, w in zip(group["image"], group["channels"], group["height"], group["width"])]
    data, mask_ = px.padded_batch(images)
    names = ("q_ids", "q_mask", "a_ids", "a_mask")
    longest = max(1, *(len(x) for k in names for x in group[k]))
    arrays = {k: np.zeros((len(group), longest), np.int32) for k in names}
    for k in names:
        for row, x in zip(arrays[k], group[k]):
            row[: len(x)] = x
    used = np.nonzero((arrays["q_mask"] != 0).any(0) | (arrays["a_mask"] != 0).any(0))[0]
    keep = int(used[-1]) + 1 if len(used) else 1
    return {"images": data, "padding_mask": mask_, **{k: v[:, :keep] for k, v in arrays.items()}, "heights": group["height"].to_numpy(np.int32), "widths": group["width"].to_numpy(np.int32), "metadata": group["metadata"].tolist()}
