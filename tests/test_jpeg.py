"""JPEG and PNG images that the JVM's own encoders write, against the JVM's own decoders."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from pairloom.functions import pixels as px
from pairloom.functions.jpeg import decode_jpeg


def drawn(w, h, seed=1):
    """A smooth picture with some edges."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:h, 0:w]
    out = np.stack([127 + 120 * np.sin(x / (5 + 3 * i) + y / (7 + i)) for i in range(3)], axis=2)
    out[h // 3 : h // 2, w // 4 : w // 2] = rng.integers(0, 255, 3)
    return np.clip(out, 0, 255).astype(np.uint8)


def written(spark, pixels, kind="jpeg", quality=0.9, progressive=False, grey=False):
    jvm = spark.sparkContext._jvm
    h, w, _ = pixels.shape
    image = jvm.java.awt.image.BufferedImage(w, h, 10 if grey else 1)
    flat = (pixels[:, :, 0].astype(int) << 16 | pixels[:, :, 1].astype(int) << 8 | pixels[:, :, 2]).astype(np.int64).ravel().tolist()
    values = spark.sparkContext._gateway.new_array(jvm.int, len(flat))
    for i, v in enumerate(flat):
        values[i] = v
    image.setRGB(0, 0, w, h, values, 0, w)
    out = jvm.java.io.ByteArrayOutputStream()
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName(kind).next()
    how = writer.getDefaultWriteParam()
    if kind == "jpeg":
        how.setCompressionMode(2)
        how.setCompressionQuality(quality)
    if progressive:
        how.setProgressiveMode(1)
    stream = jvm.javax.imageio.ImageIO.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), how)
    stream.flush()
    return bytes(out.toByteArray())


def read(spark, data):
    jvm = spark.sparkContext._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    h, w = image.getHeight(), image.getWidth()
    if image.getRaster().getNumBands() == 1:  # the stored numbers; as colours the JVM shows them lighter
        raster = image.getRaster()
        return np.repeat(np.array([raster.getSample(x, y, 0) for y in range(h) for x in range(w)]).reshape(h, w, 1), 3, axis=2)
    flat = np.array([image.getRGB(x, y) for y in range(h) for x in range(w)], np.int64).reshape(h, w)
    return np.stack([flat >> 16 & 255, flat >> 8 & 255, flat & 255], axis=2)


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("w, h", [(16, 16), (37, 21), (8, 50)])
def test_against_the_jvm(spark, w, h, progressive):
    data = written(spark, drawn(w, h), progressive=progressive)
    got, want = decode_jpeg(data).astype(int), read(spark, data)
    assert got.shape == want.shape == (h, w, 3)
    assert np.abs(got - want).max() <= 6 and np.abs(got - want).mean() < 1
    assert px.head_size(data) == (w, h)


def test_grey_and_quality(spark):
    grey = np.repeat(drawn(24, 20)[:, :, :1], 3, axis=2)
    data = written(spark, grey, grey=True, quality=0.4)
    assert np.abs(px.decode(data).astype(int) - read(spark, data)).max() <= 3


def test_damaged(spark):
    data = written(spark, drawn(40, 40))
    for bad in (b"\xff\xd8", data[:30], data[: len(data) // 2], data.replace(b"\xff\xc4", b"\xff\xfe"), b"\xff\xd8\xff\xd9"):
        with pytest.raises(ValueError):
            px.decode(bad)
    with pytest.raises(ValueError):
        px.decode(b"GIF89a....")
    assert px.head_size(b"GIF89a") == px.head_size(None) == px.head_size(b"\xff\xd8\xff") == (None, None)


def test_interlaced_png(spark):
    for w, h in ((1, 1), (5, 3), (19, 23)):
        pixels = drawn(w, h)
        assert (px.decode(written(spark, pixels, "png", progressive=True)) == pixels).all()


def png(w, h, depth, colour, lines, palette=None):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)
    return px.PNG_MARK + chunk(b"IHDR", head) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + x for x in lines))) + chunk(b"IEND", b"")


def test_depths():
    assert px.decode(png(3, 1, 1, 0, [b"\xa0"]))[0, :, 0].tolist() == [255, 0, 255]
    assert px.decode(png(3, 1, 2, 0, [b"\x1b"]))[0, :, 1].tolist() == [0, 85, 170]
    assert px.decode(png(2, 1, 4, 3, [b"\x10"], bytes([9, 8, 7, 1, 2, 3])))[0].tolist() == [[1, 2, 3], [9, 8, 7]]
    assert px.decode(png(1, 1, 16, 2, [bytes([1, 99, 2, 99, 3, 99])]))[0, 0].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        px.decode(png(2, 1, 4, 3, [b"\x20"], bytes([9, 8, 7])))
    with pytest.raises(ValueError):
        px.decode(png(3, 2, 8, 0, [b"abc"]))
