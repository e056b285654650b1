"""Problem 3: the measure, the bound, and the cutoffs."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.llm import repetition as rp

A, B, C = "The goat stands near the old stone bridge.", "Two boys carry a heavy crate of apples home.", "Nothing else moves in this quiet picture."


@pytest.mark.parametrize(
    "text, share",
    [
        (None, 0), ("", 0), ("...", 0), ("12 34 12 34", 0), (A, 0), (f"{A} {B} {C}", 0), (f"{A} {A}", 0.5), (f"{A} {A} {A}", 2 / 3), (f"1. {A}\n2. {A.upper()}\n3. {A.replace(' ', '  ')}!", 2 / 3),
        (f"Step 1: {A} Step 2: {A} Step 3: {A} Step 4: {A}", 0.75), ("自転車は赤です。自転車は赤です。自転車は赤です。", 2 / 3),
    ],
)
def test_share(text, share):
    assert rp.repeated_share(text) == pytest.approx(share, abs=0.01)


@pytest.mark.parametrize("text", ["ha " * 60, "ha" * 60, f"{A} " + "on the left side " * 20, "A goat. " + "turquoise " * 30, "very" * 40, f"{A} {B} " * 9])
def test_loops(text):
    assert rp.repeated_share(text) > 0.5


def test_lists_of_different_things():
    text = "\n".join(f"{i}. {thing} - at the {place}." for i, (thing, place) in enumerate([("Bowl", "back"), ("Table", "corner"), ("Tower", "pier"), ("Boat", "river"), ("Hat", "tree")], 1))
    assert rp.repeated_share(text) < 0.5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([A, B, C, "ha", "on the left side ", "1.", "\n", "自転車は赤です。", "Ёлка "]), max_size=12).map(" ".join), st.randoms(use_true_random=False))
def test_spacing_case_and_numbers_change_nothing(text, rnd):
    other = "".join(c.upper() if rnd.random() < 0.3 and len(c.upper()) == 1 else c + " 7"[: rnd.randrange(3)] if c not in "\n" else c for c in text if c != " " or rnd.random() < 0.5)
    assert rp.repeated_share(other) == pytest.approx(rp.repeated_share(text))


@settings(max_examples=100, deadline=None)
@given(st.text("abc. 7-Ж車", max_size=70))
def test_measure_against_brute_force(text):
    """Every stretch, sentence and loop by its definition."""
    parts = ["".join(c for c in p.casefold() if c.isalpha()) for p in re.split(r"[.!?…。！？\n\r;]+", text)]
    parts = [p for p in parts if p]
    whole, marked, starts = "".join(parts), set(), []
    at = 0
    for i, p in enumerate(parts):
        if p in parts[:i]:
            marked |= set(range(at, at + len(p)))
        for a in range(len(p)):
            for b in range(a + 1, len(p) + 1):
                weight = sum(2 if c == "車" else 1 for c in p[a:b])
                if weight >= 16:
                    if p[a:b] in starts:
                        marked |= set(range(at + a, at + b))
                    starts.append(p[a:b])
                    break
        at += len(p)
    for period in range(1, 16):
        for a in range(len(whole) - period):
            b = a
            while b + period < len(whole) and whole[b] == whole[b + period]:
                b += 1
            if b - a >= max(2 * period, 4):
                marked |= set(range(a + period, b + period))
    want = len(marked) / len(whole) if len(whole) >= 4 else 0
    assert rp.repeated_share(text) == pytest.approx(want)


def test_no_switch_by_size_or_writing():
    """A loop counts in a long text as in a short one; one sign of another script changes little."""
    long = " ".join(f"{x} {A} {y} {C[:12]}" for x, y in zip("Birch Cedar Maple".split(), "quartz basalt granite".split()))
    loop = rp.letters("na na na na na na")
    with_loop = rp.repeated_share(long + ". " + loop)
    assert with_loop * len(rp.letters(long) + loop) == pytest.approx(rp.repeated_share(long) * len(rp.letters(long)) + len(loop) - 2)
    text = f"{A} The old stone was near. {B} Old stones carry apples."
    assert rp.repeated_share(text + " 車") == pytest.approx(rp.repeated_share(text), abs=0.01)


def test_binomial():
    assert rp.binomial_tail(0, 100, 0.01) == pytest.approx(0.99**100)
    assert rp.binomial_tail(2, 4, 0.5) == pytest.approx(11 / 16)
    grid = [0.9, 0.8, 0.7, 0.6, 0.5]
    assert rp.certified_cutoff([0.1] * 500, 0.01, 0.05, grid) == 0.5
    assert rp.certified_cutoff([0.1] * 400 + [0.65] * 100, 0.01, 0.05, grid) == 0.7
    assert rp.certified_cutoff([0.1] * 20, 0.01, 0.05, grid) is None  # too few to certify
    assert rp.certified_cutoff([], 0.01, 0.05, grid) is None


def test_rate_bound():
    assert rp.rate_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-5)
    assert rp.binomial_tail(3, 500, rp.rate_bound(3, 500, 0.01)) == pytest.approx(0.01, abs=1e-3)
    assert rp.rate_bound(0, 0, 0.05) == 1


SENTENCES = [f"{x} {y} looks at the {z} quietly." for x, y, z in zip(["One", "No", "Any", "Each", "Some", "That", "This", "Your", "His"], ["horse", "teacher", "sailor", "painter", "river", "cloud", "engine", "garden", "window"], ["moon", "gate", "coal", "sand", "leaf", "milk", "rope", "wall", "door"])]


def test_holdout_labels(monkeypatch):
    """Labels come from what was planted: the measure is not asked."""
    monkeypatch.setattr(rp, "repeated_share", None)
    made = rp.holdout(SENTENCES, 200, 1)
    assert made == rp.holdout(SENTENCES, 200, 1) and sum(much for _, much in made) == 50
    monkeypatch.undo()
    wrong = sum((rp.repeated_share(t) > 0.5) != much for t, much in made)
    assert wrong <= 4


def test_errors_add_up_to_the_stated_one(spark):
    """Strata and pooled test share the error; where nothing can be certified the definition holds, and the bound says so."""
    df = spark.createDataFrame([(i, s, {"model_reasoning": "Мало."}) for i, s in enumerate(SENTENCES)], "row_index bigint, answer string, metadata map<string,string>")
    cut = rp.fit_cutoffs(df, "row_index", "answer", "metadata", "model_reasoning")
    assert [c[0] for c in cut.certificates] == ["answer/latin", "pooled/all"]
    assert all(rp.rate_bound(wrong, n, 0.025) == bound <= 0.01 for _, n, wrong, bound, _ in cut.certificates)
    for few in (rp.fit_cutoffs(df, "row_index", "answer", "metadata", "model_reasoning", size=40), rp.fit_cutoffs(df.limit(0), "row_index", "answer", "metadata", "model_reasoning")):
        assert few.default == 0.5 and few.certificates[-1][3] > 0.01


def test_table(spark):
    rows = [
        (1, f"{A} {A} {A}", {"model_reasoning": A}, "t", "f"), (2, A, {"model_reasoning": "ha " * 40, "other": f"{A} {A} {A}"}, "t", "f"), (3, None, None, None, None), (4, "", {}, "t", "f"), (5, f"{A} {B} " * 5000, {"model_reasoning": None}, "t", "f"),
        (1, f"{A} {A} {A}", None, "t", "f"), (None, "ha" * 40, None, None, None),
    ]
    df = spark.createDataFrame(rows, "row_index bigint, answer string, metadata map<string,string>, text string, field_name string")
    got = sorted(((r.row_index, r.field_name) for r in rp.repetition(df).collect()), key=repr)
    assert got == sorted([(1, "answer"), (2, "metadata"), (5, "answer"), (1, "answer"), (None, "answer")], key=repr)
    assert rp.repetition(df.limit(0)).count() == 0


def test_samples_against_the_measure(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/samples.parquet")
    cut = rp.fit_cutoffs(d, "row_index", "answer", "metadata", "model_reasoning")
    assert all(0.45 <= c <= 0.65 for c in [cut.default, *cut.by_stratum.values()])
    texts = rp.texts_of(d, "row_index", "answer", "metadata", "model_reasoning")
    share = F.pandas_udf(lambda t: t.map(rp.repeated_share).astype("float64"), "double")
    want = {(r.row_index, r.field_name) for r in texts.where(share("text") > 0.6).select("row_index", "field_name").collect()}
    got = {(r.row_index, r.field_name) for r in rp.repetition(d, cutoffs=cut).collect()}
    assert want == got and len(got) > 200
