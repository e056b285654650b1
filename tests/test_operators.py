"""Operators against plain Python, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.functions import geometry, text
from pairloom.operators import ingest, loader, manifest, ordering, shards


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_blank_is_what_python_strips(spark):
    values = ["", " ", "\t\n", " ", "　", "\x1c", "a", " a ", "​", None, " ", "\x85"]
    assert column(spark, values, "string", text.has_text) == [bool(v and v.strip()) for v in values]


def test_tokens(spark):
    values = ["a b", "", None, "  a  ", "x" * 3000]
    assert column(spark, values, "string", lambda v: F.size(text.tokens(v))) == [2, 0, 0, 1, 1]
    for got in column(spark, values, "string", lambda v: text.padded(text.token_ids(v), 3)):
        assert len(got) == 3
    assert column(spark, values, "string", lambda v: text.mask_length(text.mask(text.token_ids(v), 1))) == [1, 0, 0, 1, 1]
    assert column(spark, [[0, 1, 0], [0, 0], [], [1, 1]], "array<int>", text.last_set) == [2, 0, 0, 2]


def test_geometry(spark):
    sizes = [(1, 1), (384, 384), (385, 385), (535, 535), (10000, 2), (2, 10000), (383, 100), (None, 5), (0, 5)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(sizes)], "i int, w int, h int")
    got = df.select("i", *[v.alias(k) for k, v in geometry.preserve_aspect(F.col("w"), F.col("h"), 384).items()]).orderBy("i").collect()
    for (w, h), r in zip(sizes, got):
        if not w:
            assert r.actual_w is None and r.actual_h is None
            continue
        s = min(384 / w, 384 / h)
        assert (r.actual_w, r.actual_h) == ((w, h) if s >= 1 else (max(1, int(w * s)), max(1, int(h * s))))
    assert got[3].actual_w == 383


def test_aspect_bounds(spark):
    bounds = geometry.aspect_bounds(6)
    assert np.allclose(bounds, [0.62996, 0.79370, 1.0, 1.25992, 1.58740], atol=1e-5)
    df = spark.createDataFrame([(0, 100, 100), (1, 1, 100), (2, 100, 1), (3, 5, 0), (4, None, 5)], "i int, w int, h int")
    assert [r.b for r in df.select("i", geometry.aspect_bucket(F.col("w"), F.col("h"), 6).alias("b")).orderBy("i").collect()] == [3, 0, 5, None, 5]
    assert df.where("i = 0").select(geometry.aspect_bucket(F.col("w"), F.col("h"), 6)).first()[0] == 3


SAMPLE = "row_index bigint, sample_id string, image_bytes binary, image_width int, image_height int, question string, answer string, metadata map<string,string>, dataset_name string"


def sample(i, **over):
    row = {"row_index": i, "sample_id": f"s{i}", "image_bytes": b"x", "image_width": 1, "image_height": 1, "question": "q", "answer": "a", "metadata": None, "dataset_name": None} | over
    return tuple(row.values())


def test_validation(spark):
    bad = [{"sample_id": ""}, {"sample_id": None}, {"image_bytes": None}, {"image_bytes": b""}, {"image_width": 0}, {"image_height": None}, {"question": "　"}, {"answer": None}]
    df = spark.createDataFrame([sample(0), *[sample(i + 1, **b) for i, b in enumerate(bad)]], SAMPLE)
    got = {r.row_index: r.errors for r in ingest.with_errors(df).collect()}
    assert got[0] == [] and all(got[i + 1] == [next(iter(b))] for i, b in enumerate(bad))
    assert [r.row_index for r in ingest.valid(df).collect()] == [0]
    with pytest.raises(Exception, match="sample"):
        ingest.valid(df, fail_fast=True).collect()
    empty = spark.createDataFrame([], SAMPLE)
    assert ingest.valid(empty).count() == ingest.reject_counts(empty).count() == 0


def test_mapping_and_fallback(spark):
    df = spark.createDataFrame([(3, "pic", None), (4, "pic2", "x")], "row_index bigint, image string, ident string")
    got = ingest.map_columns(df, {"id": "ident"}).select("row_index", ingest.sample_id(F.col("id"), F.col("row_index")).alias("s"), "reasoning").orderBy("row_index").collect()
    assert [(r.s, r.reasoning) for r in got] == [("row_3", None), ("x", None)]
    nested = spark.createDataFrame([(1, (b"x", "p"), ["first", "second"]), (2, None, []), (3, (None, "p"), None)], "row_index bigint, image struct<bytes: binary, path: string>, model_answer array<string>")
    assert [(r.image, r.answer) for r in ingest.map_columns(nested).orderBy("row_index").collect()] == [(b"x", "first"), (None, None), (None, None)]
    empty = spark.createDataFrame([], "a int")
    assert ingest.first_with_rows([lambda: spark.read.parquet("/nowhere"), lambda: empty, lambda: df]).count() == 2
    with pytest.raises(ValueError):
        ingest.first_with_rows([lambda: empty])


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("id"))
    got = ordering.global_shuffle(df, "id", 42).collect()
    assert sorted(r.position for r in got) == list(range(1000))
    import hashlib

    want = sorted((r.id for r in got), key=lambda i: (hashlib.md5(f"42:0:{i}".encode()).hexdigest(), i))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == want
    # Dense, sparse and repeated ids, with nulls first, in many buckets.
    for ids in (F.col("id"), F.col("id") * F.col("id") * 900_000_007, F.when(F.col("id") > 5, F.col("id") % 50), F.lit(3).cast("bigint")):
        seq = ordering.sequential(df.select(ids.alias("id")), "id", rows_per_bucket=64).collect()
        assert sorted(r.position for r in seq) == list(range(1000))
        inorder = [r.id for r in sorted(seq, key=lambda r: r.position)]
        assert inorder == sorted(inorder, key=lambda i: (i is not None, i or 0))
    again = ordering.global_shuffle(df.repartition(7), "id", 42).collect()
    assert {(r.id, r.position) for r in again} == {(r.id, r.position) for r in got}
    assert ordering.global_shuffle(df.limit(0), "id", 1).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 120), st.integers(0, 130), st.integers(0, 5))
def test_buffer_order(n, size, seed):
    order = ordering.buffer_order(n, size, np.random.default_rng(seed))
    assert sorted(order) == list(range(n))
    if size > 0:
        assert all(out >= at - size + 1 for out, at in enumerate(order))


def test_shuffle_buffer(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    got = ordering.shuffle_buffer(df, 10, 3, "g", "id").toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("in_pos")
        assert part["id"].tolist() == list(range(g, 100, 3))  # read in order
        assert sorted(part["out_pos"]) == list(range(len(part))) and (part["out_pos"] >= part["in_pos"] - 9).all()
    orders = {g: tuple(p.sort_values("out_pos")["in_pos"].head(30)) for g, p in got.groupby("g")}
    assert len(set(orders.values())) == 3  # groups differ
    again = ordering.shuffle_buffer(df.repartition(7), 10, 3, "g", "id").toPandas()
    assert sorted(map(tuple, again.values.tolist())) == sorted(map(tuple, got.values.tolist()))
    assert ordering.shuffle_buffer(df.limit(0), 10, 3, "g", "id").count() == 0


def test_chunks_of_bad_rows(spark):
    """30 rows in chunks of 10, the middle ones bad: two shards, numbered 0 and 1."""
    df = spark.range(30).select(F.col("id").alias("row_index"), F.col("id").alias("position"), (~F.col("id").between(10, 19)).alias("ok"))
    got = shards.assign_before_errors(df, 10, F.col("ok")).collect()
    assert {(r.row_index // 10, r.shard_id) for r in got} == {(0, 0), (2, 1)} and len(got) == 20
    after = shards.assign_after_errors(df.where("ok").select("row_index"), "row_index", 15).collect()
    assert {(r.shard_id, r.local_index) for r in after} == {(i // 15, i % 15) for i in range(20)}
    assert {r.shard_id for r in shards.assign_after_errors(df.select("row_index"), "row_index", None).collect()} == {0}


def test_running_total_and_rotation(spark):
    sizes = [5, None, 7, 0, 3, 100, 1, 1]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(sizes)], "id bigint, v bigint, g int")
    got = {r.id: r.before for r in shards.running_total(df, "v", "id", width=3).collect()}
    assert got == {i: sum(x or 0 for x in sizes[:i]) for i in range(len(sizes))}
    rot = {r.id: r.local_shard for r in shards.rotate_by_size(df, "g", "v", "id", 10).collect()}
    assert [rot[i] for i in range(8)] == [0, 0, 0, 1, 1, 1, 2, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 200), st.integers(1, 12), st.sampled_from(loader.STRATEGIES))
def test_partition_covers(n, workers, strategy):
    parts = [loader.worker_indices(n, w, workers, strategy) for w in range(workers)]
    assert sorted(i for p in parts for i in p) == list(range(n))
    sizes = [len(p) for p in parts]
    assert max(sizes) - min(sizes) <= (1 if strategy == "interleaved" else -(-n // workers))


def test_partition_sizes_and_errors():
    assert [len(loader.worker_indices(5, w, 4)) for w in range(4)] == [2, 2, 1, 0]
    for bad in ((0, 0, "contiguous"), (-1, 4, "contiguous"), (4, 4, "contiguous"), (0, 4, "random")):
        with pytest.raises(ValueError):
            loader.worker_indices(10, *bad)


def test_partition_faults(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (4,), (9,), (None,)], "g bigint")
    got = {(r.fault, r["index"]) for r in loader.partition_faults(df, "g", 5).collect()}
    assert got == {("twice", 1), ("missing", 2), ("missing", 3), ("outside", 9), ("outside", None)}
    assert loader.partition_faults(spark.range(5).withColumnRenamed("id", "g"), "g", 5).count() == 0


def test_epochs_resume(spark):
    df = spark.range(103)
    whole = loader.epoch_batches(df, "id", 1, 2, 10)
    assert whole.groupBy("batch_id").count().orderBy("batch_id").toPandas()["count"].tolist() == [10] * 10 + [3]
    rest = loader.resume(loader.epoch_batches(df, "id", 1, 2, 10), 4)
    assert rest.exceptAll(whole).count() == 0 and rest.count() == 63
    other = loader.epoch_batches(df, "id", 1, 3, 10)
    assert other.exceptAll(whole).count() > 0
    assert [r.id for r in loader.epoch_batches(df, "id", 1, 2, 10, buffer=0).orderBy("position").collect()] == list(range(103))
    blocks = loader.epoch_batches(df, "id", 1, 2, 10, buffer=20).collect()
    assert all(r.id // 20 == r.position // 20 for r in blocks) and sorted(r.position for r in blocks) == list(range(103))


def entries(k):
    return {"version": 1, "created_at": "", "total_samples": 100 * k, "total_shards": k, "total_bytes": 1024 * k, "shards": [{"path": f"shard_{i:04d}.bin", "sample_count": 100, "size_bytes": 1024, "checksum_crc32": "ab"} for i in range(k)]}


@pytest.mark.parametrize("k, w, sizes", [(10, 1, [10]), (2, 4, [1, 1, 0, 0]), (12, 4, [3, 3, 3, 3]), (11, 4, [3, 3, 3, 2]), (10, 3, [4, 3, 3])])
def test_deal(k, w, sizes):
    m = entries(k)
    dealt = [manifest.deal(m, r, w) for r in range(w)]
    assert [len(d) for d in dealt] == sizes
    assert sorted(s["path"] for d in dealt for s in d) == [s["path"] for s in m["shards"]]


def test_manifest_file(tmp_path):
    m = entries(2)
    manifest.save(m, str(tmp_path / "m.json"))
    assert manifest.load(str(tmp_path / "m.json")) == m
    (tmp_path / "n.json").write_text('{"shards": [{"path": "a", "sample_count": 5}]}')
    n = manifest.load(str(tmp_path / "n.json"))
    assert (n["total_samples"], n["total_shards"]) == (5, 1)
    for rank, world in ((-1, 4), (4, 4), (0, 0)):
        with pytest.raises(ValueError):
            manifest.deal(m, rank, world)


def test_manifest_of_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        manifest.build(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        manifest.build(spark, str(tmp_path))
