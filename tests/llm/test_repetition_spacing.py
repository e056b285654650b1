"""Problem 3: repetition that words do not show, through the query."""

from __future__ import annotations

from pairloom.llm import repetition as rp

SPACING = "The red kite flies. Thered kite flies. The redkite flies. The red kiteflies."
TEXTS = [SPACING, "hahahahaha", "また赤い花が咲いてる、まだ赤い花が咲いてる、赤い花が咲いてる"]


def test_no_text_is_dropped_before_it_is_measured(spark):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(TEXTS)], "row_index bigint, answer string, metadata map<string,string>")
    got = {r.row_index: r.share for r in rp.repetition(df, cutoffs=rp.Cutoffs({}, 0.5)).collect()}
    assert got == {i: rp.repeated_share(t) for i, t in enumerate(TEXTS)} and min(got.values()) > 0.5
