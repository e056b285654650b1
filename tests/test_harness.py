"""Timed runs: what they count, not how long they take."""

from __future__ import annotations

import numpy as np

from pairloom import harness
from pairloom.functions.pixels import encode_png
from pairloom.operators import metrics


def test_sizes():
    assert harness.scaling_sizes(600) == [250, 500, 600] and harness.scaling_sizes(100) == [100] and harness.scaling_sizes(500, [500, 0, -1, 900, 7, 7]) == [7, 500]


def test_compare(spark, tmp_path):
    rows = [(i, f"s{i}", encode_png(np.full((4 + i % 3, 5, 3), i, np.uint8)) if i != 3 else b"x", 5, 4, "what is it", "a thing", None, "d") for i in range(20)]
    samples = spark.createDataFrame(rows, "row_index bigint, sample_id string, image_bytes binary, image_width int, image_height int, question string, answer string, metadata map<string,string>, dataset_name string")
    got = {r.label: r for r in harness.compare(spark, samples, str(tmp_path), sizes=[10], per_shard=8, side=8, tokens=4).runs}
    assert set(got) == {"after errors 10", "before errors 10", "fixed sizes", "per sample sizes", "loader, fixed sizes", "loader, per sample sizes", "naive"}
    assert all(got[k].samples == 9 and got[k].errors == 1 for k in ("after errors 10", "before errors 10"))
    assert got["after errors 10"].shards == 2 and got["fixed sizes"].bytes > got["per sample sizes"].bytes
    assert got["fixed sizes"].samples == 19 and got["loader, fixed sizes"].samples == 0  # two batches, all of them warm-up
    frame = harness.Timings(list(got.values())).frame(spark)
    assert metrics.speedup(frame.where("label like '%errors%'"), "per_second", frame.label == "after errors 10").count() == 2
    assert harness.Timing("x", 5, 0.0).per_second == 0
    few = harness.time_loading(spark, str(tmp_path / "per-sample"), batch_size=4, batches=3, warmup=1)
    assert few.samples == 12 and len(few.unit_ms) == 3 and few.bytes > 0
    naive = harness.time_naive_loading(samples, harness.settings("x", fixed=True, side=8), batch_size=4, batches=2, warmup=0)
    assert naive.samples <= 8 and naive.bytes == naive.samples * 3 * 8 * 8 * 4
