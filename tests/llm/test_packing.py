"""Problem 5: round trip and bounds."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import packing
from pairloom.llm.tokens import PATTERN, VOCABULARY, sizes

PATH = f"/opt/tokenizers/{VOCABULARY}"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20), st.integers(64, 128))
def test_plan(counts, capacity):
    plan = packing.plan_patterns(counts, capacity)
    used = defaultdict(int)
    for times, pattern in plan:
        assert times > 0 and sum(s * k for s, k in pattern) <= capacity
        for s, k in pattern:
            used[s] += times * k
    assert used == counts and len(plan) <= 4 * len(counts)
    if counts:
        n, total = sum(t for t, _ in plan), sum(s * c for s, c in counts.items())
        least = max(-(-total // capacity), sum(c for s, c in counts.items() if 2 * s > capacity))
        assert n <= 1.5 * least + 1


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab 'st1²½é\n\t\x1c 日本жx_-.…👩́Ⅷ"), max_size=60))
def test_counts_are_the_tokenizers(text):
    want = 0 if not text or text.isspace() else len(sizes(PATH).encoding.encode_ordinary(text))
    assert sizes(PATH).count(text) == want


def test_pattern_is_public():
    tok = pytest.importorskip("public_tokenizers")
    assert tok.PATTERN == PATTERN


DOCS = [(1, "word " * 10), (2, None), (3, "  "), (4, "cat dog " * 700), (5, "one"), (5, "one"), (6, "two words"), (None, "three small words")]


def run(spark, docs, specs, **options):
    d = spark.createDataFrame([(*x, "k", 1) for x in docs], "doc_id bigint, text string, size string, spec_id int")
    s = spark.createDataFrame(specs, "spec_id int, capacity_tokens int")
    return packing.pack(d, s, **options).collect(), {(i, t): sizes(PATH).count(t) for i, t in docs}


@pytest.mark.parametrize("per_salt", [500_000, 1])
def test_round_trip(spark, per_salt):
    got, tokens = run(spark, DOCS, [(1, 8), (1, 4), (2, 500), (2, 500), (3, 10_000), (4, None), (5, 0), (None, 7)], rows_per_salt=per_salt)
    for spec, capacity in ((1, 8), (2, 500), (3, 10_000)):
        mine = [r for r in got if r.spec_id == spec]
        filled = defaultdict(int)
        for r in mine:
            filled[r.container_id] += r.piece_tokens
        assert sorted(filled) == list(range(len(filled)))
        assert all(filled[r.container_id] + r.space_left == capacity for r in mine)
        by_doc = defaultdict(list)
        for r in mine:
            by_doc[r.doc_id].append((r.start_token, r.piece_tokens, r.piece))
        for (i, _), n in tokens.items():
            if n == 0:
                assert i not in by_doc
            elif n > capacity:  # cut without gaps
                at = 0
                for k, (start, size, piece) in enumerate(sorted(by_doc[i])):
                    assert (start, piece) == (at, k) and size <= capacity
                    at += size
                assert at == n
            else:
                assert by_doc[i] == [(0, n, 0)] * (2 if i == 5 else 1)
        lengths = packing.windows(capacity)
        inside = defaultdict(int)
        for r in mine:
            # The shortest window that holds the piece is its tier; it lies in one of that tier or a longer one.
            assert r.piece_tokens <= lengths[r.tier] and (r.tier + 1 == len(lengths) or r.piece_tokens > lengths[r.tier + 1])
            assert r.window_tier <= r.tier and r.window_tokens == lengths[r.window_tier] and 0 <= r.window < packing.FACTOR**r.window_tier
            inside[r.container_id, r.window_tier, r.window] += r.piece_tokens
        assert all(n <= lengths[t] for (_, t, _), n in inside.items())
        least = -(-sum(r.piece_tokens for r in mine) // capacity)
        assert len(filled) <= 1.3 * least + 1
    assert {r.spec_id for r in got} == {1, 2, 3}


def test_hot_size(spark):
    """Most texts have one size; places do not collide whatever the salts."""
    docs = [(i, "alpha beta gamma") for i in range(400)] + [(1000 + i, "word " * (i % 30 + 1)) for i in range(100)]
    got, _ = run(spark, docs, [(1, 32)], rows_per_salt=37, per_step=4)
    filled, groups = defaultdict(int), defaultdict(set)
    for r in got:
        filled[r.container_id] += r.piece_tokens
        groups[r.step_group].add(r.container_id)
    assert max(filled.values()) <= 32 and len(got) == 500
    full = [sum(filled[c] for c in g) for g in groups.values() if len(g) == 4]
    assert max(full) - min(full) <= 16 and max(map(len, groups.values())) == 4


def test_empty_tables(spark):
    assert run(spark, [], [(1, 8)])[0] == [] and run(spark, DOCS, [])[0] == []


def test_documents(spark):
    d, s = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "pack_specs"))
    u = packing.utilisation(packing.pack(d, s), s).collect()
    assert len(u) == 4 and all(r.fill > 0.97 for r in u)
    assert len({r.tokens for r in u}) == 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 600), st.integers(1, 40), max_size=30), st.integers(520, 700))
def test_tiers(counts, capacity):
    """Every tier opens its windows with its own texts, and every gap is too small for what a shorter tier kept."""
    counts = {s: n for s, n in counts.items() if s <= capacity}
    lengths = packing.windows(capacity)
    used = defaultdict(int)
    plan = packing.plan_tiers(counts, capacity)
    for t, (window, tier) in enumerate(zip(lengths, plan)):
        shorter = lengths[t + 1] if t + 1 < len(lengths) else 0
        left = [s for later in plan[t + 1 :] for _, pattern in later for s, _ in pattern]
        for times, pattern in tier:
            filled = sum(s * k for s, k in pattern)
            assert times > 0 and filled <= window and max(s for s, _ in pattern) > shorter
            assert not left or window - filled < min(left)
            for s, k in pattern:
                used[s] += times * k
    assert used == counts
    runs = packing.lay_out(counts, capacity)
    if counts:
        units = packing.FACTOR ** (len(lengths) - 1)
        n = -(-int(runs["end"].max()) // units)
        at = np.arange(n)
        filled = packing.tokens_before(runs, (at + 1) * units) - packing.tokens_before(runs, at * units)
        assert filled.sum() == sum(s * k for s, k in counts.items()) and filled.max() <= capacity
        assert (runs["first_unit"] % runs["span"] == 0).all()  # no window crosses the end of a container


def test_plain_first_fit_is_another_packing():
    """Two texts of a short tier share a short window; in one container each, as first-fit lays them, they do not."""
    counts, capacity = {100: 1, 60: 2, 20: 4}, 128 * 4
    tiers = packing.plan_tiers(counts, capacity)
    assert tiers == [[], [(1, [(100, 1), (20, 1)]), (1, [(60, 2)])], [(3, [(20, 1)])]]
    assert packing.plan_patterns(counts, capacity) == [(1, [(100, 1), (60, 2), (20, 4)])]


def test_short_windows_cost_no_containers():
    """With enough small texts all tiers keep their windows; where they would waste space, longer windows serve."""
    many = {s: 10 * (600 - s) for s in range(4, 513)}
    ladder, plan = packing.best_plan(many, 512)
    assert ladder == (0, 1, 2) and all(plan)
    ladder, plan = packing.best_plan({300: 4, 70: 70}, 512)  # 70 leaves 58 of 128
    assert ladder == (0, 0, 0) and sum(t for p in plan for t, _ in p) == 13


def test_audit(spark):
    d, s = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "pack_specs"))
    sizes = packing.sized(d)
    packed = packing.pack(d, s)
    n = sizes.where("tokens > 0").count()
    assert {tuple(r)[1:] for r in packing.audit(packed, s, sizes).collect()} == {(n, 0, 0, 0, 0)}
    once = packed.unionByName(packed.where("spec_id = 1 and container_id = 0"))
    wrong = {r.spec_id: r for r in packing.audit(once, s, sizes).collect()}
    assert wrong[1].overfull_containers == 1 and wrong[1].overfull_windows >= 1 and wrong[1].token_difference < 0 == wrong[2].token_difference


def test_many_sizes_listed(spark):
    """As many container sizes as are planned are also reported; more are refused."""
    d = spark.createDataFrame([(1, "one two three")], "doc_id bigint, text string")
    s = spark.createDataFrame([(i, 4 + i) for i in range(packing.MOST_SPECS)], "spec_id int, capacity_tokens int")
    assert packing.utilisation(packing.pack(d, s), s).count() == packing.MOST_SPECS
    with pytest.raises(ValueError):
        packing.pack(d, s.unionByName(s.select((s.spec_id + 5000).alias("spec_id"), "capacity_tokens")))
