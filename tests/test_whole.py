"""Queries that do the whole job at the default sizes, against counts of their own in Python."""

from __future__ import annotations

import hashlib
import os

import pytest

from pairloom.config import ImageConfig
from pairloom.operators import manifest
from pairloom.operators.process import image_record
from pairloom.plans import catalog, files, layout
from pairloom.sources.shards import read_shards

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def words(text):
    return [t for t in (text or "").split(" ") if t]


def epoch_order(rows):
    """Rows in the order of epoch 3 of seed 42, which is the order of their MD5 keys."""
    return sorted(rows, key=lambda r: (hashlib.md5(f"45:0:{r.row_index}".encode()).hexdigest(), r.row_index))


def batches_of(rows):
    ordered = epoch_order(rows)
    return [ordered[i : i + 32] for i in range(0, len(ordered), 32)]


def test_token_trim_keeps_long_answers(spark):
    s = spark.read.parquet(f"{DATA}/samples.parquet").select("row_index", "question", "answer").collect()
    has = [r for r in s if (r.question or "").strip() and (r.answer or "").strip()]
    want = {i: max(1, *(min(512, len(words(t))) for r in b for t in (r.question, r.answer))) for i, b in enumerate(batches_of(has))}
    got = {r.batch_id: r.tokens_kept for r in catalog.queries()["batch_token_trim"](spark, DATA).collect()}
    assert got == want and max(want.values()) > 64


def test_shards_hold_whole_answers(spark):
    q = catalog.queries()
    longest = max(len(words(r.answer)) for r in spark.read.parquet(f"{DATA}/samples.parquet").select("answer").collect())
    assert 32 < max(r.tokens for r in q["collate_dynamic"](spark, DATA).select("tokens").collect()) <= longest
    folder, _, _ = files._written(spark, DATA, None)
    assert all(r.rec_len > 16 * 512 for r in read_shards(spark, folder, payload=False).select("rec_len").collect())
    d = manifest.read_shard_files(spark, folder).toPandas()
    assert (d["size_bytes"] > 16 * 512 * d["sample_count"]).all()
    assert max(r.answer_tokens for r in q["shard_lookup"](spark, "/root/testdata/sf0.01").collect()) > 32


def test_collate_fixed_moves_everything(spark):
    token = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:7], 16)
    c = ImageConfig(storage_dtype="float32", dynamic_padding=False)
    s = spark.read.parquet(f"{DATA}/samples.parquet").select("row_index", "question", "answer", "image_bytes").collect()
    got = {r.batch_id: r.asDict() for r in layout.collated_fixed(spark.read.parquet(f"{DATA}/samples.parquet"), checksum=True).collect()}
    made = batches_of(s)
    assert sorted(got) == list(range(len(made)))
    for i, b in enumerate(made):
        assert got[i]["batch_size"] == len(b)
        for name, texts in (("q", [r.question for r in b]), ("a", [r.answer for r in b])):
            rows = [words(t)[:512] for t in texts]
            ids = ",".join(str(x) for w in rows for x in [*map(token, w), *[0] * (512 - len(w))])
            mask = ",".join(str(x) for w in rows for x in [1] * len(w) + [0] * (512 - len(w)))
            assert got[i][f"{name}_ids_md5"] == hashlib.md5(ids.encode()).hexdigest()
            assert got[i][f"{name}_mask_md5"] == hashlib.md5(mask.encode()).hexdigest()
        if i in (0, len(made) - 1):
            images = [image_record(r.image_bytes, c)[0] for r in b]
            assert got[i]["images"] == sum(x is not None for x in images)
            assert got[i]["pixels_md5"] == hashlib.md5(b"".join(x or bytes(3 * 384 * 384 * 4) for x in images)).hexdigest()


def test_image_fit_has_the_default_size(spark):
    sizes = {(r.height, r.width) for r in catalog.queries()["image_fit"](spark, DATA).select("height", "width").collect()}
    assert sizes - {(None, None)} == {(384, 384)}
