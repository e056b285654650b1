"""Decoding, resizing and normalising of images in numpy, for Arrow functions."""

from __future__ import annotations

import struct
import threading
import zlib
from functools import lru_cache

import numpy as np

from pairloom.functions.jpeg import decode_jpeg

PNG_MARK = b"\x89PNG\r\n\x1a\n"
KERNELS = {"bilinear": 1.0, "bicubic": 2.0, "lanczos": 3.0}
# Weights of red, green and blue in grey.
GREY = (299, 587, 114)
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


# Where the seven passes of an interlaced PNG start and how far apart their pixels are.
PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def decode(data: bytes | None) -> np.ndarray:
    """Height x width x 3 bytes (RGB) of a PNG or JPEG image, and of what else Pillow reads where it is installed.

    Raises ValueError for null, other, damaged or cut files.
    """
    data = bytes(data) if data else b""
    if data.startswith(PNG_MARK):
        return decode_png(data)
    if data.startswith(b"\xff\xd8"):
        return decode_jpeg(data)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("not a PNG or JPEG image") from None
    import io

    try:
        return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))
    except Exception as why:
        raise ValueError("not an image that can be read") from why


def head_size(data: bytes | None) -> tuple[int | None, int | None]:
    """(width, height) that a PNG or JPEG file's head tells; (None, None) for others."""
    data = bytes(data) if data else b""
    if data.startswith(PNG_MARK) and len(data) >= 24:
        return struct.unpack_from(">II", data, 16)
    at = 2
    while data.startswith(b"\xff\xd8") and at + 9 <= len(data) and data[at] == 0xFF:
        kind = data[at + 1]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        at += 2 + struct.unpack_from(">H", data, at + 2)[0] if kind != 0xFF else 1
    return None, None


def decode_png(data: bytes | None) -> np.ndarray:
    """Height x width x 3 bytes (RGB) of a PNG (1 to 16 bits, plain or interlaced; alpha is dropped).

    Raises ValueError for null, other, damaged or cut files.
    """
    if not data or not bytes(data).startswith(PNG_MARK):
        raise ValueError("not a PNG image")
    data, at, packed, palette, head = bytes(data), 8, [], None, None
    try:
        while True:
            (size,) = struct.unpack_from(">I", data, at)
            kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
            if len(body) < size or struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
                raise ValueError("damaged PNG image")
            at += 12 + size
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif kind == b"PLTE":
                palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                packed.append(body)
            elif kind == b"IEND":
                break
        w, h, depth, colour, _, _, interlace = head
        n = CHANNELS[colour]
        if depth not in (1, 2, 4, 8, 16) or not w or not h or (depth < 8 and n > 1) or interlace > 1:
            raise ValueError("damaged PNG image")
        raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    except (struct.error, zlib.error, TypeError, KeyError) as why:
        raise ValueError("damaged PNG image") from why
    out = np.zeros((h, w, n), np.uint16)
    at = 0
    for top, left, down, right in PASSES if interlace else ((0, 0, 1, 1),):
        ph, pw = -(-(h - top) // down), -(-(w - left) // right)
        if ph <= 0 or pw <= 0:
            continue
        line = -(-pw * n * depth // 8)
        part = raw[at : at + ph * (1 + line)]
        if len(part) < ph * (1 + line):
            raise ValueError("damaged PNG image")
        at += len(part)
        part = part.reshape(ph, 1 + line)
        plain = _unfilter(part[:, 0], part[:, 1:].astype(np.int16), max(1, n * depth // 8)).astype(np.uint8)
        out[top::down, left::right] = _samples(plain, depth, pw * n).reshape(ph, pw, n)
    if colour == 3:
        if palette is None or out.max() >= len(palette):
            raise ValueError("damaged PNG image")
        return palette[out[:, :, 0]]
    # Less than 8 bits are spread over 0 to 255; of 16 bits the upper 8 are kept.
    out = (out >> 8 if depth == 16 else out * (255 // ((1 << min(depth, 8)) - 1))).astype(np.uint8)
    return np.repeat(out[:, :, :1], 3, axis=2) if n < 3 else out[:, :, :3]


def _samples(lines: np.ndarray, depth: int, count: int) -> np.ndarray:
    """Numbers of ``depth`` bits, ``count`` in each line of bytes."""
    if depth == 8:
        return lines
    if depth == 16:
        return lines.view(">u2")
    bits = np.unpackbits(lines, axis=1)[:, : count * depth].reshape(len(lines), count, depth)
    return bits @ (1 << np.arange(depth - 1, -1, -1))


def _unfilter(kinds: np.ndarray, lines: np.ndarray, n: int) -> np.ndarray:
    if not kinds.any():
        return lines
    above = np.zeros(lines.shape[1], np.int16)
    for i, kind in enumerate(kinds):
        line = lines[i]
        if kind == 1:
            line = np.cumsum(line.reshape(-1, n), axis=0, dtype=np.int64).reshape(-1) & 255
        elif kind == 2:
            line = (line + above) & 255
        elif kind in (3, 4):
            line = line.copy()
            for j in range(len(line)):
                left, up = (int(line[j - n]) if j >= n else 0), int(above[j])
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    corner = int(above[j - n]) if j >= n else 0
                    p = left + up - corner
                    guess = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
                line[j] = (line[j] + guess) & 255
        elif kind:
            raise ValueError("damaged PNG image")
        lines[i] = above = line
    return lines


def encode_png(pixels: np.ndarray) -> bytes:
    """PNG of height x width x 3 bytes."""
    h, w, _ = pixels.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1)], axis=1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return PNG_MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def colour(pixels: np.ndarray, space: str) -> np.ndarray:
    """RGB pixels as RGB, BGR or one channel L."""
    if space == "RGB":
        return pixels
    if space == "BGR":
        return pixels[:, :, ::-1]
    if space == "L":
        r, g, b = (pixels[:, :, i].astype(np.int64) for i in range(3))
        return ((GREY[0] * r + GREY[1] * g + GREY[2] * b + 500) // 1000).astype(np.uint8)[:, :, None]
    raise ValueError(f"colour space {space!r} is not RGB, BGR or L")


def _kernel(name: str, x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    if name == "bilinear":
        return np.clip(1 - x, 0, None)
    if name == "bicubic":
        a = -0.5
        return np.where(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1, np.where(x < 2, (((x - 5) * x + 8) * x - 4) * a, 0))
    return np.where(x < 3, np.sinc(x) * np.sinc(x / 3), 0)


@lru_cache(maxsize=256)
def _weights(size: int, new: int, name: str) -> np.ndarray:
    """new x size matrix of weights; the kernel is widened when the size shrinks."""
    scale = size / new
    wide = max(scale, 1.0)
    centre = (np.arange(new) + 0.5) * scale
    w = _kernel(name, (np.arange(size)[None, :] + 0.5 - centre[:, None]) / wide)
    w[np.abs(np.arange(size)[None, :] + 0.5 - centre[:, None]) > KERNELS[name] * wide] = 0
    return (w / w.sum(1, keepdims=True)).astype(np.float32)


def resize(pixels: np.ndarray, h: int, w: int, interpolation: str = "bicubic") -> np.ndarray:
    """Pixels of another size; raises ValueError for an unknown interpolation or an empty size."""
    if h < 1 or w < 1:
        raise ValueError(f"size {h} x {w} is empty")
    if pixels.shape[:2] == (h, w):
        return pixels
    if interpolation == "nearest":
        ys, xs = (((np.arange(n) + 0.5) * (s / n)).astype(int) for n, s in ((h, pixels.shape[0]), (w, pixels.shape[1])))
        return pixels[ys][:, xs]
    if interpolation not in KERNELS:
        raise ValueError(f"interpolation {interpolation!r} is not nearest, {', '.join(KERNELS)}")
    rows, columns, channels = pixels.shape
    x = _weights(rows, h, interpolation) @ pixels.reshape(rows, columns * channels).astype(np.float32)
    x = x.reshape(h, columns, channels).transpose(0, 2, 1).reshape(h * channels, columns) @ _weights(columns, w, interpolation).T
    x += np.float32(0.5)
    np.clip(x, 0, 255, out=x)
    return x.astype(np.uint8).reshape(h, channels, w).transpose(0, 2, 1)


def _planar(h: int, w: int, c: int, value: int) -> np.ndarray:
    """Height x width x channels, laid out by channels, as records store them."""
    return np.full((c, h, w), value, np.uint8).transpose(1, 2, 0)


def fit(pixels: np.ndarray, target_h: int, target_w: int, strategy: str = "resize_and_pad", interpolation: str = "bicubic", pad_value: int = 0) -> np.ndarray:
    """Pixels of exactly the target size by one of three strategies."""
    h, w, c = pixels.shape
    if strategy == "resize":
        return resize(pixels, target_h, target_w, interpolation)
    if strategy == "resize_and_pad":
        s = min(target_w / w, target_h / h)
        nh, nw = int(h * s), int(w * s)
        out = _planar(target_h, target_w, c, pad_value)
        top, left = (target_h - nh) // 2, (target_w - nw) // 2
        out[top : top + nh, left : left + nw] = resize(pixels, nh, nw, interpolation)
        return out
    if strategy == "center_crop":
        s = max(target_w / w, target_h / h)
        nh, nw = max(1, int(h * s)), max(1, int(w * s))
        top, left = (nh - target_h) // 2, (nw - target_w) // 2
        # Truncation may leave a side one pixel short; the cut then reaches over the edge, where there are zeros.
        out = _planar(target_h, target_w, c, 0)
        part = resize(pixels, nh, nw, interpolation)[max(top, 0) : top + target_h, max(left, 0) : left + target_w]
        out[max(-top, 0) : max(-top, 0) + part.shape[0], max(-left, 0) : max(-left, 0) + part.shape[1]] = part
        return out
    raise ValueError(f"strategy {strategy!r} is not resize_and_pad, center_crop or resize")


def normalised(pixels: np.ndarray, mean: tuple[float, ...], std: tuple[float, ...]) -> np.ndarray:
    """Channels x height x width as float32: over 255, less the mean, over the deviation."""
    c = pixels.shape[2]
    if len(mean) != c or len(std) != c:
        raise ValueError(f"mean and std must have {c} values")
    # A byte has 256 values: they are looked up, by channel.
    values = (np.arange(256, dtype=np.float32)[None, :] / np.float32(255) - np.float32(mean)[:, None]) / np.float32(std)[:, None]
    out = np.empty((c, *pixels.shape[:2]), np.float32)
    for i in range(c):
        np.take(values[i], pixels[:, :, i], out=out[i], mode="clip")
    return out


#: Output rows that are resized and normalised at a time, so that they stay in a core's cache.
BLOCK_ROWS = 128
_own = threading.local()


def _scratch(size: int) -> np.ndarray:
    """The thread's array of at least ``size`` floats: a new one for each image costs more, in page faults, than what is done in it."""
    if getattr(_own, "scratch", None) is None or len(_own.scratch) < size:
        _own.scratch = np.empty(size, np.float32)
    return _own.scratch[:size]


def fit_normalised(out: np.ndarray, pixels: np.ndarray, strategy: str, interpolation: str, pad_value: int, mean: tuple[float, ...], std: tuple[float, ...]) -> None:
    """``normalised(fit(pixels, ..))`` of the size of ``out``, channels x height x width, written there: the same bits."""
    _, target_h, target_w = out.shape
    h, w, c = pixels.shape
    s = min(target_w / w, target_h / h)
    nh, nw = int(h * s), int(w * s)
    if strategy != "resize_and_pad" or interpolation not in KERNELS or nh < 1 or nw < 1 or (nh, nw) == (h, w) or len(mean) != c or len(std) != c:
        out[:] = normalised(fit(pixels, target_h, target_w, strategy, interpolation, pad_value), mean, std)
        return
    m, d = np.float32(mean), np.float32(std)
    pad = (np.float32(pad_value) / np.float32(255) - m) / d
    top, left = (target_h - nh) // 2, (target_w - nw) // 2
    for plane, value in zip(out, pad):
        plane[:top], plane[top + nh :] = value, value
        plane[top : top + nh, :left], plane[top : top + nh, left + nw :] = value, value
    if (pixels == pixels[0, 0]).all():  # weights sum up to 1
        out[:, top : top + nh, left : left + nw] = ((pixels[0, 0].astype(np.float32) / np.float32(255) - m) / d)[:, None, None]
        return
    lines = (_weights(h, nh, interpolation) @ pixels.reshape(h, w * c).astype(np.float32)).reshape(nh, w, c).transpose(0, 2, 1).reshape(nh * c, w)
    made = np.matmul(lines, _weights(w, nw, interpolation).T, out=_scratch(nh * c * nw).reshape(nh * c, nw))
    for a in range(0, nh, BLOCK_ROWS):
        x = made[a * c : (a + BLOCK_ROWS) * c]
        x += np.float32(0.5)
        np.clip(x, 0, 255, out=x)
        np.trunc(x, out=x)
        x /= np.float32(255)
        for i in range(c):
            part = x[i::c]
            part -= m[i]
            np.divide(part, d[i], out=out[i, top + a : top + a + len(part), left : left + nw])


def preserved(pixels: np.ndarray, longest: int, interpolation: str = "bicubic") -> np.ndarray:
    """Channels x height x width as bytes; downscaled so that no side exceeds ``longest``, never enlarged."""
    h, w, _ = pixels.shape
    s = min(longest / w, longest / h)
    if s < 1:
        pixels = resize(pixels, max(1, int(h * s)), max(1, int(w * s)), interpolation)
    return np.ascontiguousarray(pixels.transpose(2, 0, 1))


def padded_batch(images: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(images x channels x H x W float32, mask images x H x W): each image at the top left, zeros beyond it."""
    h, w = max(i.shape[1] for i in images), max(i.shape[2] for i in images)
    out = np.zeros((len(images), images[0].shape[0], h, w), np.float32)
    mask = np.zeros((len(images), h, w), np.float32)
    for k, i in enumerate(images):
        out[k, :, : i.shape[1], : i.shape[2]] = i
        mask[k, : i.shape[1], : i.shape[2]] = 1
    return out, mask


