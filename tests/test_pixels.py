from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.functions import pixels as px


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 20), st.integers(1, 20), st.integers(0, 9))
def test_png_round_trip(h, w, seed):
    x = np.random.default_rng(seed).integers(0, 256, (h, w, 3)).astype(np.uint8)
    assert (px.decode_png(px.encode_png(x)) == x).all()


@pytest.mark.parametrize("kind", [1, 2, 3, 4])
def test_png_filters(kind):
    """Lines filtered by hand come back."""
    import struct
    import zlib

    x = np.random.default_rng(kind).integers(0, 256, (6, 5, 3)).astype(np.int64)
    flat, raw = x.reshape(6, 15), b""
    for i in range(6):
        line = []
        for j in range(15):
            left, up = (flat[i, j - 3] if j >= 3 else 0), (flat[i - 1, j] if i else 0)
            corner = flat[i - 1, j - 3] if i and j >= 3 else 0
            p = left + up - corner
            paeth = left if abs(p - left) <= abs(p - up) and abs(p - left) <= abs(p - corner) else up if abs(p - up) <= abs(p - corner) else corner
            line.append((flat[i, j] - {1: left, 2: up, 3: (left + up) // 2, 4: paeth}[kind]) % 256)
        raw += bytes([kind]) + bytes(int(v) for v in line)
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    data = px.PNG_MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (px.decode_png(data) == x).all()


def test_bad_images():
    good = px.encode_png(np.zeros((4, 4, 3), np.uint8))
    for bad in (None, b"", b"not_an_image", good[:30], good[:-20], good[:40] + b"\x01" + good[41:]):
        with pytest.raises(ValueError):
            px.decode_png(bad)


@pytest.mark.parametrize("name", ["nearest", "bilinear", "bicubic", "lanczos"])
def test_resize_keeps_plain_colour(name):
    x = np.full((9, 14, 3), (10, 200, 77), np.uint8)
    for h, w in ((3, 3), (20, 5), (9, 14), (1, 1)):
        assert (px.resize(x, h, w, name) == np.array((10, 200, 77))).all()


def test_fit_and_colour():
    x = np.full((10, 20, 3), 255, np.uint8)
    p = px.fit(x, 16, 16, "resize_and_pad", pad_value=7)
    assert p.shape == (16, 16, 3) and (p[:4] == 7).all() and (p[4:12] == 255).all() and (p[12:] == 7).all()
    assert px.fit(x, 16, 16, "center_crop").shape == px.fit(x, 16, 16, "resize").shape == (16, 16, 3)
    assert px.colour(np.full((1, 1, 3), (255, 0, 0), np.uint8), "L")[0, 0, 0] == 76
    assert (px.colour(np.array([[[1, 2, 3]]], np.uint8), "BGR") == [3, 2, 1]).all()
    assert px.preserved(np.zeros((100, 50, 3), np.uint8), 20).shape == (3, 20, 10)
    assert px.preserved(np.zeros((5, 4, 3), np.uint8), 20).shape == (3, 5, 4)
    assert px.preserved(np.zeros((10000, 2, 3), np.uint8), 384).shape == (3, int(10000 * (384 / 10000)), 1)
    for wrong in (lambda: px.fit(x, 1, 1, "other"), lambda: px.resize(x, 1, 1, "other"), lambda: px.colour(x, "CMYK"), lambda: px.normalised(x, (0.5,), (0.5,))):
        with pytest.raises(ValueError):
            wrong()


def test_padded_batch():
    """Three images of 2x3, 4x1 and 3x3 become 4x3; the masks have 6, 4 and 9 pixels."""
    data, mask = px.padded_batch([np.ones((3, 2, 3), np.float32), np.ones((3, 4, 1), np.float32), np.ones((3, 3, 3), np.float32)])
    assert data.shape == (3, 3, 4, 3) and mask.sum((1, 2)).tolist() == [6, 4, 9]
    assert (data[1, :, :, 1:] == 0).all() and (data[1, :, :, 0] == 1).all()


def test_center_crop_is_what_geometry_says(spark):
    """535 pixels come out one short of 384, in the geometry as in the pixels."""
    from pyspark.sql import functions as F

    from pairloom.functions import geometry

    for w, h in ((535, 535), (20, 13), (384, 700), (7, 7)):
        g = spark.range(1).select(*[v.alias(k) for k, v in geometry.center_crop(F.lit(w), F.lit(h), 384, 384).items()]).first()
        x = np.full((h, w, 3), 200, np.uint8)
        out = px.fit(x, 384, 384, "center_crop", "nearest")
        assert (out[:, :, 0] > 0).any(0).sum() == min(384, g.new_w) and (out[:, :, 0] > 0).any(1).sum() == min(384, g.new_h)


def test_fit_normalised_has_the_same_bits():
    """Into one array, image after image: what fit and normalised say, for shapes that pad at each side, plain ones too."""
    mean, std = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
    out = np.full((3, 48, 64), np.nan, np.float32)
    r = np.random.default_rng(3)
    for h, w in ((9, 14), (48, 64), (1, 1), (40, 2), (3, 200), (150, 20), (12, 16), (64, 48)):
        for x in (r.integers(0, 256, (h, w, 3)).astype(np.uint8), np.full((h, w, 3), (1, 128, 255), np.uint8)):
            for kind, name in (("resize_and_pad", "bicubic"), ("resize_and_pad", "lanczos"), ("resize_and_pad", "nearest"), ("center_crop", "bilinear")):
                if kind == "resize_and_pad" and int(h * min(64 / w, 48 / h)) < 1:
                    continue
                px.fit_normalised(out, x, kind, name, 7, mean, std)
                assert (out == px.normalised(px.fit(x, 48, 64, kind, name, 7), mean, std)).all()
    before = out.copy()
    with pytest.raises(ValueError):
        px.fit_normalised(out, np.zeros((1, 4000, 3), np.uint8), "resize_and_pad", "bicubic", 7, mean, std)
    assert (out == before).all()
