"""Images that are measured where they are made."""

from __future__ import annotations

import hashlib
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pytest

from pairloom.config import ImageConfig
from pairloom.functions import pixels as px
from pairloom.operators import process
from pairloom.operators.process import image_into, image_record
from pairloom.plans import layout


@pytest.mark.parametrize("storage", ["float32", "uint8"])
def test_measured_is_what_decoded_makes(spark, storage):
    """Same sizes and errors, row by row, with repeated, null and broken images."""
    r = np.random.default_rng(1)
    good = [px.encode_png(r.integers(0, 256, s).astype(np.uint8)) for s in ((3, 5, 3), (40, 2, 3), (500, 500, 3))]
    images = [*good, None, b"", good[0][:30], *good, b"not_an_image", None]
    df = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in enumerate(images)], "row_index bigint, image_bytes binary")
    c = ImageConfig(storage_dtype=storage, dynamic_padding=storage == "uint8")
    got = process.measured(df, c).select("row_index", "pixels.*").collect()
    want = process.decoded(df, c).selectExpr("row_index", "octet_length(pixels.image) image_len", "pixels.channels", "pixels.height", "pixels.width", "pixels.orig_height", "pixels.orig_width", "pixels.error").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == len(images)


def test_repeated_images_are_made_once():
    made = []
    look = process.remembered(lambda data: made.append(data) or (len(data or b""), None))
    assert [look(x)[0] for x in (b"a", b"bb", None, b"a", None, b"bb")] == [1, 2, 0, 1, 0, 2] and made == [b"a", b"bb", None]


def test_image_into_has_the_pixels_of_the_record():
    c = ImageConfig(storage_dtype="float32", dynamic_padding=False)
    out = np.zeros((3, *c.target_size), np.float32)
    for seed, size in enumerate(((16, 24, 3), (15, 8, 3), (700, 400, 3), (1, 1, 3))):
        data = px.encode_png(np.random.default_rng(seed).integers(0, 256, size).astype(np.uint8))
        length, *rest = image_into(out, data, c)
        image, *want = image_record(data, c)
        assert rest == want and length == len(image) and out.tobytes() == image
    assert image_into(out, b"x", c) == image_record(b"x", c)


def test_numbers_of_padded_rows():
    rows = np.zeros((4, 5), np.int32)
    rows[0, :3], rows[2], rows[3, :1] = (7, 0, 12), range(10, 15), 9
    assert layout._numbers(rows, [3, 0, 5, 1]) == ",".join(map(str, rows.ravel().tolist()))


def test_collate_fixed_with_repeated_and_broken_images(spark):
    """A batch that repeats images, after one that left pixels behind: places of broken images are 0, others as the record says."""
    c = ImageConfig(storage_dtype="float32", dynamic_padding=False)
    a, b = (px.encode_png(np.random.default_rng(i).integers(0, 256, (9, 7 + i, 3)).astype(np.uint8)) for i in (1, 2))
    images = [(a, b"broken", b, a, None, b"broken", None)[i % 7] for i in range(70)]
    df = spark.createDataFrame([(i, "x y", "z", None if x is None else bytearray(x)) for i, x in enumerate(images)], "row_index bigint, question string, answer string, image_bytes binary").coalesce(1)
    got = {r.batch_id: r for r in layout.collated_fixed(df, checksum=True).collect()}
    order = sorted(range(70), key=lambda i: (hashlib.md5(f"45:0:{i}".encode()).hexdigest(), i))
    for k in range(3):
        made = [image_record(images[i], c)[0] for i in order[32 * k : 32 * k + 32]]
        assert got[k].images == sum(x is not None for x in made) and got[k].pixel_bytes == len(made) * 3 * 384 * 384 * 4
        assert got[k].pixels_md5 == hashlib.md5(b"".join(x or bytes(3 * 384 * 384 * 4) for x in made)).hexdigest()


def test_collate_fixed_makes_repeated_images_once(monkeypatch):
    """Inside a batch, images of the same bytes are decoded once."""
    runs, made = [], []
    monkeypatch.setattr(layout, "grouped", lambda df, *keys: type("G", (), {"groupBy": lambda s, *k: s, "applyInPandas": lambda s, run, schema: runs.append(run)})())
    monkeypatch.setattr(layout.loader, "epoch_batches", lambda df, *rest: df)
    df = MagicMock()
    monkeypatch.setattr(layout, "token_ids", lambda x: MagicMock())
    monkeypatch.setattr(layout.F, "col", lambda x: x)
    layout.collated_fixed(df)
    into = process.image_into
    monkeypatch.setattr(layout.process, "image_into", lambda out, data, c: made.append(data) or into(out, data, c))
    data = px.encode_png(np.zeros((2, 2, 3), np.uint8))
    group = pd.DataFrame({"batch_id": [0] * 3, "position": range(3), "q": [np.array([1])] * 3, "a": [np.array([1])] * 3, "image_bytes": [data, b"no", data]})
    assert runs[0](group)["images"].tolist() == [2] and made == [data, b"no"]
