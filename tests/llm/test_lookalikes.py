"""Problem 1: known spellings, and the table as a whole against the plain function."""

from __future__ import annotations


import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import lookalikes
from pairloom.llm.confusables import look_alikes
from pairloom.llm.lookalikes import canonical, canonical_columns, changed_texts, resolved

CASES = [
    ("What cοlοr is it?", "What color is it?"),  # Greek
    ("Соn mèо mướp сó thể", "Con mèo mướp có thể"),
    ("Yеѕ, а саr", "Yes, a car"),  # wholly Cyrillic words
    ("Что видно пepeд пeкapнeй?", "Что видно перед пекарней?"),
    ("Ｃhiếc nón lá ở đâu？", "Chiếc nón lá ở đâu?"),
    ("Dónde está", "Dónde está"),
    ("Is the ticket　here", "Is the ticket here"),
    ("the wh​eel­bar⁠row﻿", "the wheelbarrow"),
    ("pouri͏ng tea", "pouring tea"),
    ("haⅰ thứ ɡⅰữa ⅽửa", "hai thứ giữa cửa"),
    ("eﬃcient ﬁne", "efficient fine"),
    ("Kể tên", "Kể tên"),
    ("reste‑t‑il", "reste-t-il"),
    ("Ðây là lúc nào?", "Đây là lúc nào?"),
    ("自転車の色は緑で、傘とは違い͏ます。", "自転車の色は緑で、傘とは違います。"),
]
KEPT = [
    None, "", " ", " ", "​", "　", "12 345", "plain text", 'The sign says "Аптека".', 'A sticker reads "Ελλάδα" here.', "α = 30° and x²", "12 € for Zumbril™ soap", "½ of it", "House № 7", "H₂O",
    "It feels cosy 👨‍👩‍👧 overall.", "crème brûlée", "木のベンチはどこにありますか？", 'The box is marked "自転車？" by hand.', "Что видно слева? у реки и в саду", "a у о", "It waits…", "Größe", "❤️",
]


@pytest.mark.parametrize("text, plain", CASES)
def test_cases(text, plain):
    assert canonical(text) == plain == canonical(plain)


@pytest.mark.parametrize("text", [t for t in KEPT if t != "a у о"])
def test_kept(text):
    assert canonical(text) == text


def test_context_decides_single_words():
    assert canonical("еѕ", "Is it so?") == "es"
    assert canonical("а", "Что это?") == "а"


def test_script_sets():
    assert resolved("сор")[1] == "CL" and resolved("жук")[1] == "C" and resolved("dоg")[0] == "CL" and resolved("dоg")[1] == "L"


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcоеαΑ ​́ ｅ？жя日の‍👩ⅰ-‑"), max_size=30))
def test_idempotent(text):
    once = canonical(text)
    assert canonical(once) == once


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_index bigint, question string, answer string, text string, field_name string, context string")


def test_table(spark):
    """Nulls, empties, a very long text, repeated rows and columns of clashing names."""
    long = "the wheel " * 50_000
    rows = [(i, t, None, "x", "y", "z") for i, (t, _) in enumerate(CASES)] + [(100 + i, "q", t, "x", "y", "z") for i, t in enumerate(KEPT) if t != "a у о"]
    rows += [(500, long, long.replace("wheel", "whееl"), None, None, None)] * 2 + [(None, "whееl", None, None, None, None)]
    df = frame(spark, rows)
    got = sorted(((r.row_index, r.field_name) for r in changed_texts(df).collect()), key=repr)
    assert got == sorted([(i, "question") for i in range(len(CASES))] + [(500, "answer")] * 2 + [(None, "question")], key=repr)
    fixed = {r.row_index: r for r in canonical_columns(df).collect()}
    assert fixed[500].answer == long and fixed[0].question == CASES[0][1] and fixed[0].text == "x" and len(fixed) == df.select("row_index").distinct().count()
    assert changed_texts(frame(spark, [])).count() == canonical_columns(frame(spark, [])).count() == 0


def test_nothing_is_missed_by_the_jvm_test(spark):
    """The prefilter lets every text through that the function changes."""
    d = spark.read.parquet("/root/testdata/sf0.001/samples.parquet").select("row_index", "question", "answer")
    want = set()
    for r in d.collect():
        for f, t, o in (("question", r.question, r.answer), ("answer", r.answer, r.question)):
            if canonical(t, o) != t:
                want.add((r.row_index, f))
    assert want == {(r.row_index, r.field_name) for r in changed_texts(d).collect()} and want


UNICODE = [
    ("ꓮpple pie", "Apple pie"), ("Ꭺpple pie", "Apple pie"), ("ⲟpen it", "open it"), ("ᴀpple ᴘɪᴇ", "apple pie"), ("𝐇ello 𝓽𝓱𝓮𝓻𝓮", "Hello there"), ("hello․world", "hello.world"), ("The ꓡamp", "The Lamp"), ("ᖇed", "Red"),
    ("𝑥 = 3 and y", None), ("ᏣᎳᎩ is a word", None), ("said /ˈbɪɡ/ aloud", None), ("ℝ and ℂ are sets", None), ("الCEO", None), ("LEDライト", None), ("ꓡꓲꓢꓴ", None),
]


def test_letters_of_unicode_data(spark):
    """Alphabets that no list here names, and words that are rightly written in them."""
    df = frame(spark, [(i, t, None, None, None, None) for i, (t, _) in enumerate(UNICODE)])
    assert {r.row_index: r.canonical for r in changed_texts(df).collect()} == {i: p for i, (_, p) in enumerate(UNICODE) if p}


def test_tables(spark):
    found = look_alikes(spark)
    assert len(found) > 150 and all(v.isascii() and v.isalpha() for v in found.values())
    assert found["ꓮ"] == "A" and found["ꮯ"] == "c" and found["І"] == "I" and found["ӏ"] == "i"


def test_each_character_reaches_python(spark):
    """Each character that the function acts on, beside Latin and beside Cyrillic letters: the JVM test lets through what changes."""
    shared, pattern = lookalikes._shared(spark.sparkContext)
    spelling = shared.value
    texts = [t for c in sorted(spelling.odd) for t in (f"wa{c}ter", f"м{c}й", f"{c} тогда", f"日{c}本 b")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    through = {r.i for r in df.where(lookalikes.suspicious(df.t, df.t, pattern)).collect()}
    changed = {i for i, t in enumerate(texts) if spelling.canonical(t, t) != t}
    assert changed <= through and len(changed) > 5_000


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab оеіаѕ αο ꓮᴀ𝐇․ⲟɡ жя ́"), max_size=24))
def test_fixpoint_with_more_alphabets(text):
    spelling = lookalikes.Spelling({"ꓮ": "A", "ⲟ": "o"}, frozenset("оеіаѕαοжяꓮᴀ𝐇․ⲟɡ́"))
    once = spelling.canonical(text)
    assert spelling.canonical(once) == once
