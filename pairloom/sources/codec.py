"""Packing and parsing of shard files. Little-endian, without padding inside structures."""

from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Fixed values of the file format.
MAGIC = b"VLMSHARD"
END_MAGIC = b"SHARDEND"
VERSIONS = (1, 2)
HEADER = struct.Struct("<8sIIQIIIII20x")
ENTRY = struct.Struct("<QQ")
DIMS = struct.Struct("<4H")
FLAG_UINT8, FLAG_SAMPLE_DIMS, FLAG_LZ4, FLAG_ZSTD = 1, 2, 4, 8
FOOTER_BYTES = 12
DIM_LIMIT = 65535


@dataclass(frozen=True)
class Header:
    """First 64 bytes of a shard. Format 1 has no flags: float pixels of one size."""

    version: int
    sample_count: int
    table_at: int
    channels: int
    height: int
    width: int
    token_length: int
    flags: int = 0

    def pack(self) -> bytes:
        return HEADER.pack(MAGIC, self.version, self.sample_count, self.table_at, self.channels, self.height, self.width, self.token_length, self.flags if self.version > 1 else 0)

    @property
    def uint8(self) -> bool:
        return bool(self.flags & FLAG_UINT8)

    @property
    def sample_dims(self) -> bool:
        return bool(self.flags & FLAG_SAMPLE_DIMS)

    @property
    def lz4(self) -> bool:
        return bool(self.flags & FLAG_LZ4)


@dataclass(frozen=True)
class Record:
    """One sample: pixels (channels, height, width) as uint8 or float32, four token arrays, JSON text."""

    pixels: np.ndarray
    q_ids: np.ndarray
    q_mask: np.ndarray
    a_ids: np.ndarray
    a_mask: np.ndarray
    metadata: str
    orig_height: int
    orig_width: int


def parse_header(data: bytes) -> Header:
    """Raises ValueError for a short file, another magic or version, or flags that cannot be read."""
    if len(data) < HEADER.size:
        raise ValueError(f"a shard header has {HEADER.size} bytes, there are {len(data)}")
    magic, version, count, at, c, h, w, t, flags = HEADER.unpack(data[: HEADER.size])
    if magic != MAGIC:
        raise ValueError(f"not a shard: it starts with {magic!r}")
    if version not in VERSIONS:
        raise ValueError(f"shard version {version} is not one of {VERSIONS}")
    if version == 1:
        flags = 0
    if flags & FLAG_ZSTD:
        raise ValueError("zstd records are not supported")
    return Header(version, count, at, c, h, w, t, flags)


def parse_table(data: bytes, count: int) -> list[tuple[int, int]]:
    """[(offset, length), ..]; raises ValueError if the table is cut short."""
    if len(data) < count * ENTRY.size:
        raise ValueError("the offset table is cut short")
    return list(ENTRY.iter_unpack(data[: count * ENTRY.size]))


def lz4_pack(raw: bytes) -> bytes:
    """Length of the raw bytes and one LZ4 block."""
    import pyarrow as pa

    return struct.pack("<I", len(raw)) + pa.Codec("lz4_raw").compress(raw, asbytes=True)


def lz4_unpack(data: bytes) -> bytes:
    import pyarrow as pa

    (size,) = struct.unpack_from("<I", data)
    return pa.Codec("lz4_raw").decompress(data[4:], decompressed_size=size, asbytes=True)


def pack_record(r: Record, header: Header) -> bytes:
    """Bytes of a record; raises ValueError for pixels or token arrays that do not fit the header."""
    t = header.token_length
    arrays = [np.ascontiguousarray(a, dtype="<i4") for a in (r.q_ids, r.q_mask, r.a_ids, r.a_mask)]
    if any(a.shape != (t,) for a in arrays):
        raise ValueError(f"token arrays must have length {t}")
    if r.pixels.ndim != 3 or r.pixels.shape[0] != header.channels:
        raise ValueError(f"pixels must be ({header.channels}, height, width)")
    parts = []
    if header.version == 2:
        _, h, w = r.pixels.shape
        parts += [DIMS.pack(*(min(int(x), DIM_LIMIT) for x in (r.orig_height, r.orig_width, h, w))), np.ascontiguousarray(r.pixels, dtype=np.uint8).tobytes()]
    else:
        if r.pixels.shape[1:] != (header.height, header.width):
            raise ValueError(f"format 1 needs pixels of {header.height} x {header.width}")
        parts.append(np.ascontiguousarray(r.pixels, dtype="<f4").tobytes())
    meta = r.metadata.encode("utf-8")
    raw = b"".join([*parts, *(a.tobytes() for a in arrays), struct.pack("<I", len(meta)), meta])
    return lz4_pack(raw) if header.lz4 else raw


def parse_record(data: bytes, header: Header) -> Record:
    """Inverse of :func:`pack_record`; raises ValueError if a part runs over the end."""
    if header.lz4:
        data = lz4_unpack(data)
    at = 0
    h, w = header.height, header.width
    oh, ow = h, w
    if header.sample_dims:
        if len(data) < DIMS.size:
            raise ValueError("the record is cut short")
        oh, ow, h, w = DIMS.unpack_from(data)
        at = DIMS.size
    kind = np.dtype("u1") if header.uint8 else np.dtype("<f4")
    n, t = header.channels * h * w, header.token_length
    if at + n * kind.itemsize + 16 * t + 4 > len(data):
        raise ValueError("the record is cut short")
    pixels = np.frombuffer(data, kind, n, at).reshape(header.channels, h, w)
    at += n * kind.itemsize
    arrays = []
    for _ in range(4):
        arrays.append(np.frombuffer(data, "<i4", t, at))
        at += 4 * t
    (size,) = struct.unpack_from("<I", data, at)
    if at + 4 + size > len(data):
        raise ValueError("the record is cut short")
    return Record(pixels, *arrays, data[at + 4 : at + 4 + size].decode("utf-8"), oh, ow)


def denormalise(pixels: np.ndarray, how: str = "none", mean: tuple[float, ...] = (0.485, 0.456, 0.406), std: tuple[float, ...] = (0.229, 0.224, 0.225)) -> np.ndarray:
    """Stored bytes as they are ('none'), over 255 ('unit'), or with mean and deviation of each channel ('meanstd')."""
    if how == "none" or pixels.dtype != np.uint8:
        return pixels
    x = pixels.astype(np.float32)
    if how == "unit":
        return x / np.float32(255)
    if how != "meanstd":
        raise ValueError(f"normalize {how!r} is not none, unit or meanstd")
    c = pixels.shape[0]
    if len(mean) < c or len(std) < c:
        raise ValueError(f"mean and std must have {c} values")
    scale = np.array([1 / (255 * s) for s in std[:c]], np.float32)
    bias = np.array([-m / s for m, s in zip(mean[:c], std[:c])], np.float32)
    return x * scale[:, None, None] + bias[:, None, None]


def body_crc(path: str, chunk: int = 1 << 22) -> int:
    """CRC-32 of all bytes before the footer."""
    left, crc = os.path.getsize(path) - FOOTER_BYTES, 0
    with open(path, "rb") as f:
        while left > 0 and (part := f.read(min(chunk, left))):
            crc, left = zlib.crc32(part, crc), left - len(part)
    return crc


def verify(path: str) -> None:
    """Raises ValueError for a file without footer, another end magic, or another checksum."""
    if os.path.getsize(path) < HEADER.size + FOOTER_BYTES:
        raise ValueError(f"{path} is cut short")
    with open(path, "rb") as f:
        f.seek(-FOOTER_BYTES, os.SEEK_END)
        footer = f.read()
    if footer[4:] != END_MAGIC:
        raise ValueError(f"{path} has no end mark")
    (want,) = struct.unpack("<I", footer[:4])
    if (have := body_crc(path)) != want:
        raise ValueError(f"{path}: checksum {have:08x}, stored {want:08x}")


class ShardFile:
    """Reads one shard: header and offsets at once, records on demand."""

    def __init__(self, path: str, verify_crc: bool = False):
        if verify_crc:
            verify(path)
        self.path, self._file = path, open(path, "rb")
        try:
            self.header = parse_header(self._file.read(HEADER.size))
            self._file.seek(self.header.table_at)
            self.offsets = parse_table(self._file.read(self.header.sample_count * ENTRY.size), self.header.sample_count)
        except BaseException:
            self._file.close()
            raise

    def __len__(self) -> int:
        return len(self.offsets)

    def raw(self, index: int) -> bytes:
        if not 0 <= index < len(self.offsets):
            raise IndexError(f"sample {index} of {len(self.offsets)}")
        at, size = self.offsets[index]
        self._file.seek(at)
        data = self._file.read(size)
        if len(data) < size:
            raise ValueError(f"{self.path}: record {index} is cut short")
        return data

    def __getitem__(self, index: int) -> Record:
        return parse_record(self.raw(index), self.header)

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> ShardFile:
        return self

    def __exit__(self, *why: object) -> None:
        self.close()


class ShardWriter:
    """Writes one shard under a temporary name; :meth:`close` completes it, :meth:`abort` removes it."""

    def __init__(self, path: str, channels: int, height: int, width: int, token_length: int, version: int = 2, lz4: bool = False, alignment: int = 64):
        if alignment < 1 or alignment & (alignment - 1):
            raise ValueError("alignment must be a power of 2")
        if version not in VERSIONS:
            raise ValueError(f"version must be one of {VERSIONS}")
        flags = (FLAG_UINT8 | FLAG_SAMPLE_DIMS if version == 2 else 0) | (FLAG_LZ4 if lz4 else 0)
        if version == 1 and lz4:
            raise ValueError("format 1 has no compression")
        self.path, self.alignment = path, alignment
        self.header = Header(version, 0, 0, channels, height, width, token_length, flags)
        self.offsets: list[tuple[int, int]] = []
        self._file = open(path, "w+b")
        self._file.write(self.header.pack())

    def _align(self) -> None:
        self._file.write(bytes(-self._file.tell() % self.alignment))

    def add(self, record: Record) -> None:
        if self._file.closed:
            raise RuntimeError("the shard is closed")
        data = pack_record(record, self.header)
        self._align()
        self.offsets.append((self._file.tell(), len(data)))
        self._file.write(data)

    def close(self) -> tuple[int, int, str]:
        """(samples, bytes, checksum as 8 hexadecimal digits)."""
        self._align()
        at = self._file.tell()
        for o in self.offsets:
            self._file.write(ENTRY.pack(*o))
        h = self.header
        self._file.seek(0)
        self._file.write(Header(h.version, len(self.offsets), at, h.channels, h.height, h.width, h.token_length, h.flags).pack())
        self._file.flush()
        self._file.seek(0)
        crc = 0
        while part := self._file.read(1 << 22):
            crc = zlib.crc32(part, crc)
        self._file.write(struct.pack("<I", crc) + END_MAGIC)
        size = self._file.tell()
        self._file.close()
        return len(self.offsets), size, f"{crc:08x}"

    def abort(self) -> None:
        self._file.close()
        if os.path.exists(self.path):
            os.remove(self.path)
