"""Queries over shards hold a few shard files at a time, whatever the size of the table."""

from __future__ import annotations

import glob
import os

import numpy as np
import pyarrow as pa
import pytest

from pairloom.pipeline import layout_options, ready
from pairloom.plans import catalog, files
from pairloom.sources.shards import pass_shards

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def files_in(folder):
    return [f for _, _, names in os.walk(folder) for f in names]


def test_no_more_shards_than_tasks(spark):
    valid, places, c = files._planned(spark, DATA, None)
    folder = files._shared(spark, "shards")

    def count(own, kept):
        there = glob.glob(f"{folder}/*/shard_*.bin")
        yield pa.RecordBatch.from_pylist([{"files": len(there), "rows": len(kept)}])

    got = pass_shards(ready(valid, places, c), folder, count, "files bigint, rows bigint", lambda b: b.column("local_index").to_pylist(), **layout_options(c)).collect()
    assert len(got) == -(-places.count() // 1000) and sum(r.rows for r in got) == places.count()
    assert max(r.files for r in got) <= spark.sparkContext.defaultParallelism and not files_in(folder)


def test_prints_tell_every_field():
    """The fingerprint of a record changes with each thing that a shard stores."""
    row = {"shard_id": 0, "local_index": 0, "image": b"123", "channels": 3, "height": 1, "width": 1, "orig_height": 4, "orig_width": 5, "metadata": "{}"}
    tokens = np.arange(16, dtype=np.int32).reshape(4, 1, 4)
    of = lambda r, t: files._prints(pa.RecordBatch.from_pylist([r]), list(t))[0]
    others = [of(row | {k: b"124" if k == "image" else "[]" if k == "metadata" else v + 1}, tokens) for k, v in row.items()]
    for i in range(4):
        changed = tokens.copy()
        changed[i, 0, 3] += 1
        others.append(of(row, changed))
    assert of(row, tokens) == of(dict(row), tokens.copy()) and len({of(row, tokens), *others}) == 14


@pytest.mark.parametrize("name", ["shard_roundtrip", "shard_files", "shard_lookup", "collate_dynamic"])
def test_shards_do_not_stay(spark, monkeypatch, name):
    folders, shared = [], files._shared
    monkeypatch.setattr(files, "_shared", lambda *given: folders.append(shared(*given)) or folders[-1])
    assert catalog.queries()[name](spark, DATA).collect()
    assert folders and not [f for folder in folders for f in files_in(folder)]
