"""End to end: rows to shards, shards to batches, and the stream."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.config import ImageConfig, PipelineConfig, ShardConfig, TokenizerConfig
from pairloom.functions.pixels import encode_png
from pairloom.operators import manifest, process
from pairloom.operators.delivery import BatchLoader, Checkpoint, LoaderConfig, to_torch
from pairloom.operators.ingest import sampled
from pairloom.pipeline import assigned, canonical_samples, decodable, main, run
from pairloom.sources import shards as shard_files
from pairloom.sources.readers import read_first, read_images, read_rows
from pairloom.sources.shards import read_shards, write_shards
from pairloom.streaming.arrivals import arrivals, arrival_counts, deduplicated, shard_sink

SAMPLE = "row_index bigint, sample_id string, image_bytes binary, image_width int, image_height int, question string, answer string, metadata map<string,string>, dataset_name string"


def picture(i, h=16, w=16):
    return encode_png(np.full((h, w, 3), (i * 9 % 256, 0, 255 - i), np.uint8))


def samples(spark, n, bad=(), sizes=None):
    rows = [(i, f"sample_{i}", b"not_an_image" if i in bad else picture(i, *(sizes(i) if sizes else (16, 16))), 16, 16, f"Question {i}", f"Answer {i} is here", {"k": f"v{i}"}, "d") for i in range(n)]
    return spark.createDataFrame(rows, SAMPLE)


def settings(tmp_path, **over):
    base = PipelineConfig(tokenizer=TokenizerConfig(max_length=16), shard=ShardConfig(output_dir=str(tmp_path / "out"), max_samples_per_shard=10, manifest_path=str(tmp_path / "m.json")))
    return replace(base, **over)


def test_counts_and_content(spark, tmp_path):
    c = settings(tmp_path)
    s = run(spark, c, samples(spark, 25, bad={2, 7}))
    assert (s["total_samples"], s["processed_samples"], s["error_samples"], s["shards_written"]) == (25, 23, 2, 3)
    m = manifest.load(c.shard.manifest_path)
    assert m["total_samples"] == 23 and m["total_bytes"] == sum(os.path.getsize(os.path.join(c.shard.output_dir, x["path"])) for x in m["shards"])
    rows = read_shards(spark, c.shard.output_dir, verify_crc=True).orderBy("shard_id", "local_index").collect()
    ids = [json.loads(r.metadata)["sample_id"] for r in rows]
    assert ids == [f"sample_{i}" for i in range(25) if i not in (2, 7)]
    i = int(ids[4].split("_")[1])
    assert bytes(rows[4].image) == bytes([i * 9 % 256]) * 256 + bytes(256) + bytes([255 - i]) * 256
    assert json.loads(rows[4].metadata)["original_width"] == 16
    assert [(r.shard_id, r.local_index) for r in rows] == [(s, i) for s, n in ((0, 8), (1, 10), (2, 5)) for i in range(n)]
    assert sum(rows[4].q_mask) == 2 and sum(rows[4].a_mask) == 4 and json.loads(rows[4].metadata)["k"] == f"v{i}"


def test_shards_of_what_can_be_processed(spark, tmp_path):
    """Without workers shards are cut after errors are known; places are those inside the shard."""
    c = settings(tmp_path, num_workers=0)
    assert run(spark, c, samples(spark, 35, bad={2, 7}))["shards_written"] == 4
    rows = read_shards(spark, c.shard.output_dir, verify_crc=True).collect()
    found = {(r.shard_id, r.local_index): json.loads(r.metadata)["sample_id"] for r in rows}
    good = [i for i in range(35) if i not in (2, 7)]
    assert found == {(k // 10, k % 10): f"sample_{i}" for k, i in enumerate(good)}
    places = {r.row_index: (r.shard_id, r.local_index) for r in assigned(decodable(samples(spark, 35, bad={2, 7}), c), c).collect()}
    assert places == {i: (k // 10, k % 10) for k, i in enumerate(good)}
    assert dict(assigned(decodable(samples(spark, 3), c), c).dtypes) == {"row_index": "bigint", "shard_id": "bigint", "local_index": "bigint"}


def test_a_chunk_of_errors_leaves_no_gap(spark, tmp_path):
    """30 rows in chunks of 10 of which the second cannot be decoded: two shards with dense numbers."""
    c = settings(tmp_path)
    s = run(spark, c, samples(spark, 30, bad=set(range(10, 20))))
    assert (s["shards_written"], s["processed_samples"], s["error_samples"]) == (2, 20, 10)
    assert sorted(n for n in os.listdir(c.shard.output_dir) if n.endswith(".bin")) == ["shard_0000.bin", "shard_0001.bin"]
    rows = read_shards(spark, c.shard.output_dir).where("shard_id = 1").orderBy("local_index").collect()
    assert [json.loads(r.metadata)["sample_id"] for r in rows] == [f"sample_{i}" for i in range(20, 30)]
    s = run(spark, replace(c, streaming_chunk_size=7, shard=replace(c.shard, max_samples_per_shard=None)), samples(spark, 30))
    assert s["shards_written"] == 5 and sorted(os.listdir(c.shard.output_dir))[-5:] == [f"shard_{i:04d}.bin" for i in range(5)]


def test_manifest_of_the_commit_is_that_of_the_bytes(spark, tmp_path):
    c = settings(tmp_path)
    run(spark, c, samples(spark, 25))
    read, said = manifest.build(spark, c.shard.output_dir), manifest.committed(c.shard.output_dir)
    assert {**read, "created_at": ""} == {**said, "created_at": ""}
    with pytest.raises(FileNotFoundError):
        manifest.committed(str(tmp_path))


def test_a_commit_that_was_cut_off_is_finished(spark, tmp_path):
    """New files under temporary names and the journal: the next reader puts them in place, once or twice."""
    c = settings(tmp_path)
    out = c.shard.output_dir
    run(spark, c, samples(spark, 25))
    want = {n: open(os.path.join(out, n), "rb").read() for n in os.listdir(out) if n.endswith(".bin")}
    said = shard_files.listing(out)
    for done in ((), ("shard_0001.bin",)):
        moves = []
        for n in want:
            if n not in done:
                os.replace(os.path.join(out, n), os.path.join(out, f".tmp-x-{n}"))
            moves.append([f".tmp-x-{n}", n])
        open(os.path.join(out, "shard_0009.bin"), "wb").write(b"former")
        shard_files._put(os.path.join(out, shard_files.JOURNAL), {"move": moves, "drop": ["shard_0009.bin"], "listing": said})
        assert read_shards(spark, out, verify_crc=True).count() == 25
        assert {n: open(os.path.join(out, n), "rb").read() for n in os.listdir(out) if n.endswith(".bin")} == want
        assert not os.path.exists(os.path.join(out, shard_files.JOURNAL))


def test_numbers_come_from_names(spark, tmp_path):
    """Above 9,999 shards names do not sort as numbers do; a pattern does not renumber."""
    c = settings(tmp_path)
    run(spark, c, samples(spark, 25))
    os.makedirs(tmp_path / "many")
    for k, n in enumerate((1001, 9999, 10000)):
        (tmp_path / "many" / f"shard_{n:04d}.bin").write_bytes(open(os.path.join(c.shard.output_dir, f"shard_{k:04d}.bin"), "rb").read())
    many = str(tmp_path / "many")
    assert [r.shard_id for r in read_shards(spark, many).groupBy("shard_id").count().orderBy("shard_id").collect()] == [1001, 9999, 10000]
    assert {r.shard_id for r in read_shards(spark, many, pattern="shard_100*.bin").collect()} == {1001, 10000}
    assert shard_files.shard_counts(many) == [(1001, 10), (9999, 10), (10000, 5)]


@pytest.mark.parametrize("shuffling", ["global", "local"])
def test_shuffles_keep_all(spark, tmp_path, shuffling):
    c = settings(tmp_path, shuffling=shuffling)
    run(spark, c, samples(spark, 25))
    one = [r.metadata for r in read_shards(spark, c.shard.output_dir).orderBy("shard_id", "local_index").collect()]
    run(spark, c, samples(spark, 25).repartition(3))
    two = [r.metadata for r in read_shards(spark, c.shard.output_dir).orderBy("shard_id", "local_index").collect()]
    assert one == two and len(set(one)) == 25
    order = [int(json.loads(x)["sample_id"].split("_")[1]) for x in one]
    assert order != sorted(order)
    if shuffling == "local":
        assert all(sorted(order[a : a + 10]) == list(range(a, min(a + 10, 25))) for a in (0, 10, 20))


def test_by_size_lz4_and_format_1(spark, tmp_path):
    for workers in (0, 4):
        c = settings(tmp_path, num_workers=workers, shard=ShardConfig(output_dir=str(tmp_path / "lz"), compression="lz4"))
        assert run(spark, c, samples(spark, 5))["shards_written"] == 1
    assert read_shards(spark, str(tmp_path / "lz"), verify_crc=True).count() == 5
    c = settings(tmp_path, image=ImageConfig(target_size=(4, 6), storage_dtype="float32", dynamic_padding=False), shard=ShardConfig(output_dir=str(tmp_path / "v1"), format_version=1, max_samples_per_shard=10))
    run(spark, c, samples(spark, 3))
    r = read_shards(spark, str(tmp_path / "v1")).first()
    assert (r.height, r.width, len(r.image)) == (4, 6, 4 * 72)


def test_nothing_valid_and_fail_fast(spark, tmp_path):
    c = settings(tmp_path)
    assert run(spark, c, samples(spark, 3, bad={0, 1, 2}))["shards_written"] == 0
    assert run(spark, c, samples(spark, 3).limit(0))["total_samples"] == 0
    with pytest.raises(Exception, match="PNG"):
        run(spark, replace(c, fail_fast=True), samples(spark, 3, bad={1}))
    with pytest.raises(Exception, match="question"):
        run(spark, replace(c, fail_fast=True), samples(spark, 3).withColumn("question", F.lit(" ")))


def test_tokens(spark, tmp_path):
    """Truncation, lengths in the metadata, special tokens and the padding token of a tokenizer file."""
    c = settings(tmp_path, tokenizer=TokenizerConfig(max_length=3, dynamic_text_padding=True))
    run(spark, c, samples(spark, 2))
    r = read_shards(spark, c.shard.output_dir).where("local_index = 0").first()
    assert json.loads(r.metadata)["actual_answer_length"] == 3 and json.loads(r.metadata)["actual_question_length"] == 2
    assert list(r.q_mask) == [1, 1, 0] and list(r.a_mask) == [1, 1, 1] and r.q_ids[2] == 0
    assert read_shards(spark, c.shard.output_dir, trim_tokens=True).where("local_index = 0").select(F.size("q_ids"), F.size("q_mask"), F.size("a_ids")).first()[:] == (2, 2, 3)
    s = run(spark, replace(c, tokenizer=TokenizerConfig(max_length=3, truncation=False)), samples(spark, 2))
    assert s["processed_samples"] == 0 and s["error_samples"] == 2
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[PAD]": 7, "[CLS]": 1, "a": 2, "[UNK]": 3}, unk_token="[UNK]"))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    t.post_processor = tokenizers.processors.TemplateProcessing(single="[CLS] $A", special_tokens=[("[CLS]", 1)])
    t.save(str(tmp_path / "tok.json"))
    for special, want in ((True, [1, 2, 3]), (False, [2, 3])):
        k = TokenizerConfig(name="tok.json", folder=str(tmp_path), add_special_tokens=special)
        assert list(spark.range(1).select(process.ids_of(F.lit("a b"), k)).first()[0]) == want and process.pad_id(k) == 7


def test_images_of_mapped_rows(spark, tmp_path):
    """Sizes come from the images; what is no image has none and is rejected."""
    raw = spark.createDataFrame([(0, picture(1, 5, 9), "q", "a"), (1, b"no image", "q", "a"), (2, None, "q", "a")], "row_index bigint, image binary, question string, model_answer string")
    c = settings(tmp_path)
    got = {r.row_index: (r.image_width, r.image_height) for r in canonical_samples(raw, c).collect()}
    assert got == {0: (9, 5), 1: (None, None), 2: (None, None)}
    assert run(spark, c, raw)["processed_samples"] == 1
    (tmp_path / "a.png").write_bytes(picture(3, 4, 6))
    nested = spark.createDataFrame([(0, (picture(1), None), "x"), (1, (None, str(tmp_path / "a.png")), "y"), (2, (None, str(tmp_path / "lost")), "z"), (3, None, None)], "row_index bigint, image struct<bytes: binary, path: string>, image_id string")
    got = {r.row_index: (r.sample_id, r.image_width, r.image_height) for r in canonical_samples(nested, c).collect()}
    assert got == {0: ("x", 16, 16), 1: ("y", 6, 4), 2: ("z", None, None), 3: ("row_3", None, None)}


def test_lookup_and_layout_check(spark, tmp_path):
    c = settings(tmp_path)
    run(spark, c, samples(spark, 25))
    df = read_shards(spark, c.shard.output_dir, shard_id=1, local_index=[3, 4, 99])
    assert [json.loads(r.metadata)["sample_id"] for r in df.orderBy("local_index").collect()] == ["sample_13", "sample_14"]
    assert read_shards(spark, c.shard.output_dir, payload=False, split=4).where("image is null").count() == 25
    floats = read_shards(spark, c.shard.output_dir, normalize="unit", shard_id=0, local_index=0).first()
    assert len(floats.image) == 4 * 768
    with pytest.raises(Exception, match="nowhere"):
        read_shards(spark, str(tmp_path / "nowhere")).count()
    write_shards(read_shards(spark, c.shard.output_dir, shard_id=0), str(tmp_path / "copy"), token_length=16)
    assert (tmp_path / "copy" / "shard_0000.bin").read_bytes()[64:300] == open(os.path.join(c.shard.output_dir, "shard_0000.bin"), "rb").read()[64:300]


def test_loader(spark, tmp_path):
    c = settings(tmp_path)
    run(spark, c, samples(spark, 25, sizes=lambda i: (8 + i % 3, 5 + i % 4)))
    records = read_shards(spark, c.shard.output_dir)
    seen = []
    for rank in (0, 1):
        load = BatchLoader(records, LoaderConfig(batch_size=4, rank=rank, world_size=2, normalize="none"))
        got = list(load)
        assert [b["batch_id"] for b in got] == list(range(len(load)))
        for b in got:
            n, ch, h, w = b["images"].shape
            assert (h, w) == (max(b["heights"]), max(b["widths"])) and ch == 3
            assert b["padding_mask"].sum((1, 2)).tolist() == [x * y for x, y in zip(b["heights"], b["widths"])]
            assert b["q_ids"].shape[1] == 4  # 'Answer i is here'
            seen += [json.loads(m)["sample_id"] for m in b["metadata"]]
    assert sorted(seen) == sorted(f"sample_{i}" for i in range(25))
    # The same from the files, where tasks seek the records.
    direct = BatchLoader(c.shard.output_dir, LoaderConfig(batch_size=4, batches_per_task=2), spark=spark)
    joined = list(BatchLoader(records, LoaderConfig(batch_size=4)))
    assert len(direct) == len(joined) == 7 and direct.has_next()
    for b in joined:
        other = direct.next()
        assert other["batch_id"] == b["batch_id"] and other["metadata"] == b["metadata"] and (other["images"] == b["images"]).all() and (other["q_ids"] == b["q_ids"]).all()
    assert not direct.has_next()
    with pytest.raises(RuntimeError):
        direct.next()
    assert list(direct) == []
    half = BatchLoader(c.shard.output_dir, LoaderConfig(batch_size=4), spark=spark)
    assert [half.next()["batch_id"], half.next_torch()["batch_id"]] == [0, 1]
    half.stop()
    assert [b["batch_id"] for b in half] == [2, 3, 4, 5, 6]
    load = BatchLoader(records, LoaderConfig(batch_size=4), Checkpoint(42, 0, 3))
    rest = list(load)
    whole = list(BatchLoader(records, LoaderConfig(batch_size=4)))
    assert [b["metadata"] for b in rest] == [b["metadata"] for b in whole[3:]]
    load.reset()
    assert load.checkpoint == Checkpoint(42, 1, 0)
    assert [b["metadata"] for b in load] != [b["metadata"] for b in whole]
    assert set(to_torch(rest[0])) == set(rest[0])


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 2)], "x string, y int")
    df.write.json(str(tmp_path / "j"))
    got = read_rows(spark, str(tmp_path / "j"), "json").collect()
    assert sorted(r.row_index for r in got) == [0, 1, 2]
    assert read_first(spark, [str(tmp_path / "none"), str(tmp_path / "j")], "json").count() == 3
    with pytest.raises(ValueError):
        read_rows(spark, "x", "xml")
    with pytest.raises(ValueError, match="none"):
        read_first(spark, [str(tmp_path / "none")], "json")
    for k in range(3):  # rows are numbered in the order of files and rows
        spark.range(1000 * k, 1000 * k + 1000, 1, 1).write.parquet(str(tmp_path / "p" / f"x={k}"))
    got = read_rows(spark, str(tmp_path / "p")).select("id", "row_index").collect()
    assert len(got) == 3000 and all(r.id == r.row_index for r in got)
    some = sampled(read_rows(spark, str(tmp_path / "p")), 5, 1)
    assert some.count() == 5 and some.collect() == sampled(read_rows(spark, str(tmp_path / "p")).repartition(3), 5, 1).collect()
    os.makedirs(tmp_path / "img")
    (tmp_path / "img" / "a.png").write_bytes(encode_png(np.array([[[1, 2, 3], [4, 5, 6]]], np.uint8)))
    r = read_images(spark, str(tmp_path / "img")).first()
    assert (r.width, r.height, bytes(r.pixels)) == (2, 1, bytes([1, 2, 3, 4, 5, 6]))


def test_command(spark, tmp_path):
    samples(spark, 12, bad={3}).write.parquet(str(tmp_path / "in"))
    (tmp_path / "c.yaml").write_text(f"dataset: {{path: {tmp_path}/in}}\ntokenizer: {{max_length: 8}}\nshard: {{output_dir: {tmp_path}/o1}}\n")
    assert main(["--config", str(tmp_path / "c.yaml")]) == 1
    assert main(["--config", str(tmp_path / "c.yaml"), "--set", "dataset.max_samples=3", "--set", f"shard.output_dir={tmp_path}/o2"]) == 0
    assert read_shards(spark, str(tmp_path / "o2")).count() == 3


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    samples(spark, 12).coalesce(1).write.parquet(src)
    samples(spark, 20).where("row_index >= 12").coalesce(1).write.mode("append").parquet(src)
    stream = arrivals(spark, src, samples(spark, 1).schema, files=1)
    q = shard_sink(stream, settings(tmp_path), str(tmp_path / "cp"))
    q.awaitTermination()
    folders = sorted(d for d in os.listdir(tmp_path / "out") if d.startswith("batch-"))
    assert len(folders) == 2 and sum(read_shards(spark, str(tmp_path / "out" / d)).count() for d in folders) == 20


def test_stream_windows(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.sql("select * from values (1, timestamp'2030-01-01 01:00:00'), (1, timestamp'2030-01-01 01:30:00'), (2, timestamp'2030-01-02 05:00:00'), (3, timestamp'2030-03-01 00:00:00') as t(id, ts)").write.parquet(src)
    stream = arrivals(spark, src, spark.read.parquet(src).schema)
    q = arrival_counts(deduplicated(stream, ["id"], "ts"), "ts", late=None).writeStream.outputMode("append").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.rows for r in spark.table("counts").collect()) >= 2
