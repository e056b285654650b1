"""Decoding of JPEG images (baseline and progressive Huffman coding) in numpy.

Entropy-coded bits are read in a Python loop of one step for each coefficient that
is not zero; everything after that (dequantisation, inverse cosine transform,
upsampling, colour) is array arithmetic over all blocks at once.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import numpy as np

# Fixed value: place in the 8 x 8 block of each coefficient in the order of the file.
ZIGZAG = np.array(
    [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
)
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_COS = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(1 / 8) if u == 0 else 0.5) for x in range(8)] for u in range(8)])


@dataclass
class Component:
    """One colour plane: sampling factors, quantisation table, coefficients of its blocks."""

    h: int
    v: int
    table: int
    wide: int = 0  # blocks that the image needs
    high: int = 0
    data: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 64), np.int32))
    flat: list = field(default_factory=list)
    stride: int = 0


class _Bits:
    """Bits of one stretch of entropy-coded data; beyond its end there are zeros, as far as a code can reach."""

    def __init__(self, data: bytes):
        data = data.replace(b"\xff\x00", b"\xff")
        self.size = 8 * len(data)
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint64)
        self.words = (raw[:-4] << 32 | raw[1:-3] << 24 | raw[2:-2] << 16 | raw[3:-1] << 8 | raw[4:]).tolist()  # 40 bits from each byte on
        self.at = 0

    def peek(self) -> int:
        """The next 16 bits."""
        at = self.at
        if at > self.size:
            raise ValueError("the image is cut short")
        return (self.words[at >> 3] >> (24 - (at & 7))) & 0xFFFF

    def take(self, n: int) -> int:
        if not n:
            return 0
        value = self.peek() >> (16 - n)
        self.at += n
        return value

    def code(self, table: list[int]) -> int:
        entry = table[self.peek()]
        if not entry:
            raise ValueError("damaged JPEG image")
        self.at += entry >> 8
        return entry & 255

    def signed(self, n: int) -> int:
        """A number of ``n`` bits; those that begin with 0 are negative."""
        value = self.take(n)
        return value if not n or value >> (n - 1) else value - (1 << n) + 1


def _huffman(counts: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits: length of the code that they begin with, times 256, plus its symbol; 0 for none."""
    out = np.zeros(1 << 16, np.int64)
    code = place = 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            first = code << (16 - length)
            out[first : first + (1 << (16 - length))] = length << 8 | symbols[place]
            code, place = code + 1, place + 1
        code <<= 1
    return out.tolist()


class _Image:
    def __init__(self, data: bytes):
        self.data, self.tables, self.codes = data, {}, {}
        self.components: dict[int, Component] = {}
        self.order: list[int] = []
        self.restart = 0
        self.adobe: int | None = None
        self.progressive = False

    def frame(self, body: bytes) -> None:
        depth, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        if depth != 8 or not self.height or not self.width or n not in (1, 3, 4):
            raise ValueError("JPEG images of 8 bits with 1, 3 or 4 colours are supported")
        for i in range(n):
            key, sampling, table = body[6 + 3 * i : 9 + 3 * i]
            self.components[key] = Component(sampling >> 4, sampling & 15, table)
            self.order.append(key)
        if any(not 1 <= x <= 4 for c in self.components.values() for x in (c.h, c.v)):
            raise ValueError("damaged JPEG image")
        self.hmax, self.vmax = max(c.h for c in self.components.values()), max(c.v for c in self.components.values())
        self.across, self.down = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
        for c in self.components.values():
            c.wide, c.high = -(-self.width * c.h // (8 * self.hmax)), -(-self.height * c.v // (8 * self.vmax))
            c.stride = self.across * c.h
            c.flat = [0] * (64 * c.stride * self.down * c.v)

    def scan(self, body: bytes, at: int) -> int:
        """Read the scan that begins at ``at``; returns where it ends."""
        n = body[0]
        parts = [(self.components[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
        first, last, approx = body[1 + 2 * n : 4 + 2 * n]
        high, low = approx >> 4, approx & 15
        if not self.progressive:
            first, last, high, low = 0, 63, 0, 0
        if last > 63 or first > last or (first and n > 1):
            raise ValueError("damaged JPEG image")
        found = _SCAN_END.search(self.data, at)
        end = found.start() if found else len(self.data)
        stretches = _RESTART.split(self.data[at:end])
        if n == 1:
            c = parts[0][0]
            units = [[(parts[0], 64 * (y * c.stride + x))] for y in range(c.high) for x in range(c.wide)]
        else:
            units = [
                [(p, 64 * ((my * p[0].v + v) * p[0].stride + mx * p[0].h + h)) for p in parts for v in range(p[0].v) for h in range(p[0].h)]
                for my in range(self.down) for mx in range(self.across)
            ]
        step = self.restart or len(units)
        read = self._read_block if not self.progressive else self._first_dc if not first and not high else self._more_dc if not first else self._first_ac if not high else self._more_ac
        for k in range(0, len(units), step):
            if k // step >= len(stretches):
                raise ValueError("the image is cut short")
            bits = _Bits(stretches[k // step])
            before = {id(p[0]): 0 for p in parts}
            self.skip = 0
            for unit in units[k : k + step]:
                for (c, dc, ac), place in unit:
                    read(bits, c, place, dc, ac, before, first, last, low)
        return end

    def _read_block(self, bits, c, place, dc, ac, before, first, last, low) -> None:
        before[id(c)] += bits.signed(bits.code(self.codes[0, dc]))
        c.flat[place] = before[id(c)]
        table, flat, k = self.codes[1, ac], c.flat, 1
        while k < 64:
            symbol = bits.code(table)
            size = symbol & 15
            if size:
                k += symbol >> 4
                if k > 63:
                    raise ValueError("damaged JPEG image")
                flat[place + k] = bits.signed(size)
                k += 1
            elif symbol == 0xF0:
                k += 16
            else:
                break

    def _first_dc(self, bits, c, place, dc, ac, before, first, last, low) -> None:
        before[id(c)] += bits.signed(bits.code(self.codes[0, dc]))
        c.flat[place] = before[id(c)] << low

    def _more_dc(self, bits, c, place, dc, ac, before, first, last, low) -> None:
        c.flat[place] |= bits.take(1) << low

    def _first_ac(self, bits, c, place, dc, ac, before, first, last, low) -> None:
        if self.skip:
            self.skip -= 1
            return
        table, k = self.codes[1, ac], first
        while k <= last:
            symbol = bits.code(table)
            run, size = symbol >> 4, symbol & 15
            if size:
                k += run
                if k > last:
                    raise ValueError("damaged JPEG image")
                c.flat[place + k] = bits.signed(size) << low if size else 0
                k += 1
            elif run == 15:
                k += 16
            else:
                self.skip = (1 << run) + bits.take(run) - 1
                break

    def _more_ac(self, bits, c, place, dc, ac, before, first, last, low) -> None:
        flat, table, k, one = c.flat, self.codes[1, ac], first, 1 << low

        def refine(at: int) -> None:
            if bits.take(1) and not abs(flat[at]) & one:
                flat[at] += one if flat[at] > 0 else -one

        if not self.skip:
            while k <= last:
                symbol = bits.code(table)
                run, size = symbol >> 4, symbol & 15
                value = 0
                if size:
                    value = one if bits.take(1) else -one
                elif run < 15:
                    self.skip = (1 << run) + bits.take(run)
                    break
                while k <= last:
                    at = place + k
                    if flat[at]:
                        refine(at)
                    elif run:
                        run -= 1
                    else:
                        break
                    k += 1
                if value and k <= last:
                    flat[place + k] = value
                k += 1
        if self.skip:
            for at in range(place + k, place + last + 1):
                if flat[at]:
                    refine(at)
            self.skip -= 1

    def plane(self, c: Component) -> np.ndarray:
        """Samples of a component in the size of the image."""
        rows = self.down * c.v
        blocks = np.zeros((rows * c.stride, 64))
        blocks[:, ZIGZAG] = np.array(c.flat, np.float64).reshape(-1, 64) * self.tables[c.table]
        shown = np.einsum("ux,nuv,vy->nxy", _COS, blocks.reshape(-1, 8, 8), _COS, optimize=True)
        out = shown.reshape(rows, c.stride, 8, 8).transpose(0, 2, 1, 3).reshape(8 * rows, 8 * c.stride)
        out = np.clip(np.rint(out + 128), 0, 255)
        h, w = -(-self.height * c.v // self.vmax), -(-self.width * c.h // self.hmax)
        out = out[:h, :w]
        for axis, times in ((0, self.vmax // c.v), (1, self.hmax // c.h)):
            out = _doubled(out, axis) if times == 2 else np.repeat(out, times, axis)
        return out[: self.height, : self.width]

    def pixels(self) -> np.ndarray:
        planes = [self.plane(self.components[k]) for k in self.order]
        if len(planes) == 1:
            return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
        transformed = self.adobe != 0 if len(planes) == 3 else self.adobe == 2
        if len(planes) == 3 and self.adobe is None and bytes(self.order) == b"RGB":
            transformed = False
        if transformed:
            y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
            # The file format's colour matrix.
            planes[:3] = [np.clip(np.rint(x), 0, 255) for x in (y + 1.402 * cr, y - 0.344136286 * cb - 0.714136286 * cr, y + 1.772 * cb)]
        if len(planes) == 4:  # inks are stored inverted, and so need no inversion here
            planes = [np.rint(p * planes[3] / 255) for p in planes[:3]]
        return np.stack(planes[:3], axis=2).astype(np.uint8)


def _doubled(x: np.ndarray, axis: int) -> np.ndarray:
    """Twice as many samples along an axis, each three parts of the nearer and one of the farther neighbour."""
    x = np.moveaxis(x, axis, 0)
    before, after = np.concatenate([x[:1], x[:-1]]), np.concatenate([x[1:], x[-1:]])
    out = np.empty((2 * len(x), *x.shape[1:]))
    out[0::2], out[1::2] = (3 * x + before) / 4, (3 * x + after) / 4
    return np.moveaxis(np.rint(out), 0, axis)


def decode_jpeg(data: bytes) -> np.ndarray:
    """Height x width x 3 bytes (RGB). Raises ValueError for other, damaged or cut files."""
    if not data.startswith(b"\xff\xd8"):
        raise ValueError("not a JPEG image")
    image, at = _Image(data), 2
    scans = 0
    try:
        while True:
            while data[at] != 0xFF or data[at + 1] in (0x00, 0xFF):
                at += 1
            kind = data[at + 1]
            at += 2
            if kind == 0xD9:
                break
            if 0xD0 <= kind <= 0xD8 or kind == 1:
                continue
            (size,) = struct.unpack_from(">H", data, at)
            body = data[at + 2 : at + size]
            if len(body) < size - 2:
                raise ValueError("the image is cut short")
            at += size
            if kind == 0xDB:
                k = 0
                while k < len(body):
                    wide = body[k] >> 4
                    image.tables[body[k] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, k + 1).astype(np.float64)
                    k += 1 + (128 if wide else 64)
            elif kind == 0xC4:
                k = 0
                while k < len(body):
                    counts = body[k + 1 : k + 17]
                    image.codes[body[k] >> 4, body[k] & 15] = _huffman(counts, body[k + 17 : k + 17 + sum(counts)])
                    k += 17 + sum(counts)
            elif kind in (0xC0, 0xC1, 0xC2):
                image.progressive = kind == 0xC2
                image.frame(body)
            elif 0xC3 <= kind <= 0xCF and kind != 0xC8 and kind != 0xCC:
                raise ValueError("JPEG images in Huffman coding are supported")
            elif kind == 0xDD:
                (image.restart,) = struct.unpack(">H", body)
            elif kind == 0xEE and body.startswith(b"Adobe"):
                image.adobe = body[11]
            elif kind == 0xDA:
                at = image.scan(body, at)
                scans += 1
        if not scans:
            raise ValueError("damaged JPEG image")
        return image.pixels()
    except (struct.error, IndexError, KeyError, AttributeError) as why:
        raise ValueError("damaged JPEG image") from why
