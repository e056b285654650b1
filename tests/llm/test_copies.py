"""Problem 2 against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pairloom.llm import copies
from pairloom.storage import list_names, new_path

SCHEMA = "row_index bigint, sample_id string, image_bytes binary, question string, key string, id string, bucket int, ingested_at timestamp"


def plain(t):
    return re.sub(r"[\W_]+", "", (t or "").lower())


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "i", 1, None) for r in rows], SCHEMA)


ROWS = [
    (5, "a-1", b"x", "What is it?"), (1, "A 1 ", b"x", "what is it"), (9, "a_1", b"x", " WHAT  is it ?!"),  # one set
    (2, "a-1", b"y", "What is it?"), (3, "a-2", b"x", "What is it?"), (4, "a-1", b"x", "What was it?"),  # other image, id, question
    (6, None, None, None), (7, None, None, ""), (8, "", b"", None),  # null image, empty image
    (10, "n", b"z", "x" * 100_000), (11, "n", b"z", "X" * 100_000),
]


def brute(rows):
    sets = defaultdict(list)
    for i, s, b, q in rows:
        sets[(b, plain(s), plain(q))].append(i)
    return sorted((min(v), i) for v in sets.values() for i in v if i != min(v)), sorted((min(v), len(v)) for v in sets.values())


def run(df, batch, batches, **options):
    rows = copies.keyed(df)
    ledger = copies.build_ledger(rows, batch, batches, **options)
    found = sorted((r.keep_id, r.copy_id) for r in copies.copy_pairs(rows, ledger).collect())
    return found, sorted((r.first_id, r.copies) for r in ledger.read().collect())


def test_batches_do_not_matter(spark):
    df = table(spark, ROWS)
    want = brute(ROWS)
    assert run(df, F.lit(0), 1) == want
    assert run(df, F.pmod("id", F.lit(3)), 3) == want
    assert run(df, F.when(F.col("id") > 4, F.lit(0)), 2, buckets=7) == want  # the earliest comes last


def test_hot_sets(spark):
    """A third of all rows in one set: broadcast, not shuffled; nothing is lost."""
    rows = [(i, "hot" if i % 3 == 0 else f"c{i // 2}", b"p", "q") for i in range(3000)]
    df = table(spark, rows)
    keyed = copies.keyed(df)
    ledger = copies.build_ledger(keyed, F.pmod("id", F.lit(2)), 2)
    want = brute(rows)[0]
    for hot in (1, 10, 10**6):
        assert sorted((r.keep_id, r.copy_id) for r in copies.copy_pairs(keyed, ledger, hot).collect()) == want


def test_repeated_rows_nulls_and_empty_tables(spark):
    twice = [(1, "a", b"x", "q"), (1, "a", b"x", "q"), (2, "a", b"x", "q")]
    found, led = run(table(spark, twice), F.lit(0), 1)
    assert found == [(1, 2)] and led == [(1, 3)]
    rows = copies.keyed(table(spark, [(None, "a", b"x", "q"), (3, "a", b"x", "q")]))
    ledger = copies.build_ledger(rows, F.lit(0), 1)
    assert ledger.read().first().copies == 2 and ledger.read().first().first_id == 3
    assert run(table(spark, []), F.lit(0), 2) == ([], [])


def test_samples(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/samples.parquet")
    rows, ledger = copies.samples_ledger(d)
    got = sorted((r.keep_id, r.copy_id) for r in copies.copy_pairs(rows, ledger).collect())
    data = [(r.row_index, r.sample_id, None if r.image_bytes is None else bytes(r.image_bytes), r.question) for r in d.select("row_index", "sample_id", "image_bytes", "question").collect()]
    assert got == brute(data)[0] and got
    assert sorted((r.keep_row_index, r.copies) for r in copies.collapsed(d).collect()) == brute(data)[1]
    assert copies.samples_ledger(d.limit(0))[1].read().count() == 0


def test_ledger_outlives_its_session(spark):
    """Deliveries folded by ledgers that were opened anew give what one pass gives; former versions stay readable."""
    rows = [(i, f"s{i % 40}", b"p", "q") for i in range(300)]
    root = new_path(spark, "test-ledger")
    first = copies.build_ledger(copies.keyed(table(spark, rows[:100])), F.lit(0), 1, root=root)
    again = copies.Ledger.open(spark.newSession(), root)
    assert again.version == 1 and again.files == first.files and again.keys == 40
    again.fold(copies.keyed(table(spark, rows[100:200])))
    assert sorted(r.copies for r in first.read().collect()) == [2] * 20 + [3] * 20  # its files are still there
    third = copies.Ledger.open(spark, root)
    third.fold(copies.keyed(table(spark, rows[200:])))
    assert third.version == 3 and sorted((r.first_id, r.copies) for r in copies.Ledger.open(spark, root).read().collect()) == brute(rows)[1]
    assert [n for n in list_names(spark, f"{root}/versions") if n.endswith(".json") and not n.startswith(".")] == ["00000002.json", "00000003.json"]


def test_a_version_is_committed_once(spark):
    root = new_path(spark, "test-ledger")
    copies.build_ledger(copies.keyed(table(spark, ROWS)), F.lit(0), 1, root=root)
    one, other = copies.Ledger.open(spark, root), copies.Ledger.open(spark, root)
    one.fold(copies.keyed(table(spark, ROWS)))
    with pytest.raises(FileExistsError):
        other.fold(copies.keyed(table(spark, ROWS)))
    assert copies.Ledger.open(spark, root).version == 2
    with pytest.raises(FileNotFoundError):
        copies.Ledger.open(spark, new_path(spark, "no-ledger"))


def test_buckets_are_files_and_grow(spark):
    """A file for each bucket and version; more buckets once they are too full."""
    rows = [(i, f"s{i}", b"p", "q") for i in range(200)]
    ledger = copies.Ledger(spark, new_path(spark, "test-ledger"), buckets=2, keys_per_bucket=10)
    ledger.fold(copies.keyed(table(spark, rows[:30])))
    assert ledger.buckets == 2 and all(len([n for n in list_names(spark, f"{p}/bucket={b}") if n.endswith(".parquet")]) == 1 for b, (p, _) in ledger.files.items())
    ledger.fold(copies.keyed(table(spark, rows)))
    assert ledger.buckets == 23 and ledger.keys == 200 and sorted(r.copies for r in ledger.read().collect()) == [1] * 170 + [2] * 30
    assert sum(n for _, n in ledger.files.values()) == 200
