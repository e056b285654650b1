"""Shard bytes, checked with struct and zlib and not with the codec itself."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.sources.codec import Record, ShardFile, ShardWriter, denormalise, lz4_pack, lz4_unpack, parse_header

T = 128
META = {"extra": {"very": {"deeply": [1, True, "x", None]}}}


def record(h=17, w=31, fill=42, t=T, kind=np.uint8):
    ids = lambda first: np.array([first] + [0] * (t - 1), np.int32)
    return Record(np.full((3, h, w), fill, kind), ids(9999), np.ones(t, np.int32), ids(8888), np.ones(t, np.int32), json.dumps(META), 10000, 2)


def write(path, records, **options):
    w = ShardWriter(str(path), 3, 384, 384, T, **options)
    for r in records:
        w.add(r)
    return w.close()


def test_bytes(tmp_path):
    path = tmp_path / "shard_0000.bin"
    n, size, crc = write(path, [record(), record(5, 7, 1)])
    data = path.read_bytes()
    assert (n, size) == (2, len(data))
    magic, version, count, table, c, h, w, t, flags = struct.unpack("<8sIIQIIIII", data[:44])
    assert (magic, version, count, c, h, w, t, flags) == (b"VLMSHARD", 2, 2, 3, 384, 384, T, 3)
    first, second = struct.unpack_from("<4Q", data, table)[:2], struct.unpack_from("<4Q", data, table)[2:]
    assert first == (64, 8 + 3 * 17 * 31 + 16 * T + 4 + len(json.dumps(META)))
    assert second[0] % 64 == 0 and second[0] >= sum(first)
    assert struct.unpack_from("<4H", data, 64) == (10000, 2, 17, 31)
    assert data[72 : 72 + 3 * 17 * 31] == bytes([42]) * (3 * 17 * 31)
    assert data[-8:] == b"SHARDEND"
    assert struct.unpack("<I", data[-12:-8])[0] == zlib.crc32(data[:-12]) == int(crc, 16)


@pytest.mark.parametrize("options", [{}, {"lz4": True}, {"alignment": 4096}])
def test_round_trip(tmp_path, options):
    path = tmp_path / "s.bin"
    write(path, [record(), record(1, 1, 7)], **options)
    with ShardFile(str(path), verify_crc=True) as s:
        assert len(s) == 2
        r = s[0]
        assert (r.pixels == 42).all() and r.pixels.shape == (3, 17, 31)
        assert r.q_ids[0] == 9999 and r.a_ids[0] == 8888 and (r.orig_height, r.orig_width) == (10000, 2)
        assert json.loads(r.metadata) == META
        assert s[1].pixels.shape == (3, 1, 1)
        with pytest.raises(IndexError):
            s[2]
        with pytest.raises(IndexError):
            s[-1]


def test_format_1(tmp_path):
    w = ShardWriter(str(tmp_path / "s.bin"), 3, 4, 6, T, version=1)
    w.add(record(4, 6, 0.25, kind=np.float32))
    with pytest.raises(ValueError):
        w.add(record(5, 6, 0.25, kind=np.float32))
    w.close()
    with ShardFile(str(tmp_path / "s.bin"), True) as s:
        assert s.header.flags == 0 and (s[0].pixels == np.float32(0.25)).all() and s[0].orig_width == 6


@pytest.mark.parametrize("at", [0, 70, 900, -20, -10, -3])
def test_any_changed_byte_is_found(tmp_path, at):
    path = tmp_path / "s.bin"
    write(path, [record()])
    data = bytearray(path.read_bytes())
    data[at] ^= 1
    path.write_bytes(data)
    with pytest.raises(ValueError):
        ShardFile(str(path), verify_crc=True)


def test_bad_files(tmp_path):
    for data in (b"", b"x" * 63, b"NOTSHARD" + bytes(56), b"VLMSHARD" + struct.pack("<I", 3) + bytes(52), b"VLMSHARD" + struct.pack("<I", 2) + bytes(28) + struct.pack("<I", 8) + bytes(20)):
        with pytest.raises(ValueError):
            parse_header(data)
    path = tmp_path / "s.bin"
    write(path, [record()])
    path.write_bytes(path.read_bytes()[:-5])
    with pytest.raises(ValueError):
        ShardFile(str(path), verify_crc=True)
    with pytest.raises(ValueError):
        ShardWriter(str(path), 3, 1, 1, T, alignment=48)
    w = ShardWriter(str(path), 3, 1, 1, T)
    w.close()
    with pytest.raises(RuntimeError):
        w.add(record(1, 1))


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=5000))
def test_lz4(data):
    assert lz4_unpack(lz4_pack(data)) == data


def test_denormalise():
    x = np.arange(256, dtype=np.uint8).reshape(1, 16, 16)
    assert denormalise(x) is x
    assert np.allclose(denormalise(x, "unit"), x / 255)
    assert np.allclose(denormalise(x, "meanstd", (0.485,), (0.229,)), (x / 255 - 0.485) / 0.229, atol=1e-6)
    with pytest.raises(ValueError):
        denormalise(x, "other")
