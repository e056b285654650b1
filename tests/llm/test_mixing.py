"""Problem 6 against arithmetic."""

from __future__ import annotations

import pytest

from pairloom.llm import mixing


def docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, source string, mix_id string, copies int")


def targets(spark, rows):
    return spark.createDataFrame(rows, "mix_id int, source_name string, target_weight double, max_repeats int")


DOCS = [(i, "word " * 10, "Big_Source " if i % 2 else "big-source") for i in range(2000)] + [(5000 + i, "word " * 10, "small") for i in range(100)] + [(9000, None, "small"), (9001, " ", "small"), (9002, "x", None), (9003, "y", "unnamed"), (None, "word " * 10, "small")]


def test_shares_and_repeats(spark):
    t = targets(spark, [(1, "big-source", 3.0, 1), (1, "SMALL", 1.0, 4), (1, "lost", 5.0, 2), (1, "unused", 0.0, 2), (2, "small", 7.0, 3), (3, "big-source", 1.0, 2), (3, "small", 1.0, 2), (None, "small", 1.0, 1), (4, None, 1.0, 1), (4, "lost", 1.0, 1)])
    uses, plan = mixing.mix(docs(spark, DOCS), t)
    rates = {(r.mix_id, r.source): r for r in plan.collect()}
    small, big = 101, 2000  # documents with tokens, all of one size
    assert rates[(1, "small")].rate == pytest.approx(4.0) and rates[(1, "big-source")].rate == pytest.approx(3 * 4 * small / big)
    assert rates[(1, "lost")].rate == rates[(1, "unused")].rate == 0 and rates[(2, "small")].rate == pytest.approx(3.0)
    assert rates[(3, "small")].rate == pytest.approx(2.0) and rates[(3, "big-source")].rate == pytest.approx(2 * small / big)
    got = uses.collect()
    assert all(r.copies == 4 for r in got if (r.mix_id, r.source) == (1, "small")) and all(r.copies == 3 for r in got if r.mix_id == 2)
    assert len([r for r in got if r.mix_id == 2]) == small
    assert not {9000, 9001, 9002, 9003} & {r.doc_id for r in got}
    for r in mixing.shares(uses, plan).collect():
        assert r.most_copies <= r.max_repeats
        assert r.actual_share == pytest.approx(r.target_share, abs=0.05)
    assert {r.mix_id for r in got} == {1, 2, 3}


def test_seed_and_partitions(spark):
    d, t = docs(spark, DOCS), targets(spark, [(1, "big-source", 1.0, 1), (1, "small", 1.0, 1)])
    key = lambda u: sorted((r.doc_id, r.copies) for r in u.where("doc_id is not null").collect())
    one = key(mixing.mix(d, t)[0])
    assert one == key(mixing.mix(d.repartition(5), t)[0]) != key(mixing.mix(d, t, seed=7)[0])


def test_named_twice_and_empty(spark):
    uses, plan = mixing.mix(docs(spark, DOCS), targets(spark, [(1, "small", 1.0, 3), (1, "Small ", 1.0, 2), (1, "big_source", 2.0, None)]))
    r = {x.source: x for x in plan.collect()}
    assert r["small"].max_repeats == 2 and r["small"].weight == 2.0 and r["big-source"].max_repeats == 1
    assert uses.count() > 0
    for d, t in ((DOCS, []), ([], [(1, "small", 1.0, 3)])):
        uses, plan = mixing.mix(docs(spark, d), targets(spark, t))
        assert uses.count() == 0 and mixing.shares(uses, plan).count() == len(t)


def test_documents(spark):
    uses, plan = mixing.mix(*(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "mix_targets")))
    s = mixing.shares(uses, plan).collect()
    assert len(s) == 41 and all(r.most_copies <= r.max_repeats for r in s)
    assert all(abs(sum(r.target_share for r in s if r.mix_id == m) - 1) < 1e-9 and abs(sum(r.actual_share for r in s if r.mix_id == m) - 1) < 1e-9 for m in (1, 2, 3, 4))


def test_size_asked_for(spark):
    """Sources that their greatest number keeps from their share fall short, and the report says so."""
    t = targets(spark, [(1, "big-source", 1.0, 2), (1, "small", 1.0, 3)])
    uses, plan = mixing.mix(docs(spark, DOCS), t, total_tokens=20_000)
    got = {r.source: r for r in mixing.shares(uses, plan).collect()}
    per = {r.source: r.tokens for r in plan.collect()}
    assert got["small"].wanted_tokens == got["big-source"].wanted_tokens == 10_000
    assert got["small"].used_tokens == 3 * per["small"] == 10_000 - got["small"].shortfall_tokens and got["small"].most_copies == 3
    assert got["big-source"].shortfall_tokens == 0 and got["big-source"].used_tokens == pytest.approx(10_000, rel=0.1)
    assert all(r.shortfall_tokens == 0 for r in mixing.shares(*mixing.mix(docs(spark, DOCS), t)).collect())


def test_audit(spark):
    uses, plan = mixing.mix(*(spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "mix_targets")), total_tokens=200_000)
    assert all(r.out_of_range == 0 for r in mixing.audit(uses, plan).collect())
    assert sum(r.out_of_range for r in mixing.audit(uses.withColumn("copies", uses.copies + 2), plan).collect()) == uses.count()
