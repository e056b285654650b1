"""Summaries against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions.numeric import ceil_div, is_power_of_two, per_second, percent_reduction
from pairloom.operators import metrics


def test_quantiles(spark):
    """Hot, small, tied, null and empty groups."""
    rng = np.random.default_rng(3)
    groups = {"hot": rng.lognormal(0, 2, 30_000), "one": [5.0], "two": [1.0, 2.0], "ties": [3.0] * 500 + [4.0] * 500, None: [7.0, 9.0, 8.0], "signs": rng.normal(0, 1, 999)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    whole = {r.g: r for r in metrics.quantiles(df, "g", "x", shares).collect()}
    got = {r.g: r for r in metrics.quantiles(df, "g", "x", shares, small=2000).collect()}
    assert whole == got
    assert set(got) == set(groups) | {"none"} and got["none"].n == 0 and got["none"].c is None
    for k, vs in groups.items():
        assert got[k].n == len(vs) and got[k].mean == pytest.approx(np.mean(vs))
        assert [got[k][s] for s in shares] == pytest.approx([np.percentile(vs, 100 * p) for p in shares.values()])
    assert metrics.quantiles(df.limit(0), "g", "x", shares).count() == 0


def test_numbers(spark):
    df = spark.createDataFrame([(0, 3), (1, 0), (7, 2), (64, 8), (None, 1)], "a int, b int")
    c = F.col
    assert [r[0] for r in df.where("b > 0").select(ceil_div(c("a"), c("b"))).collect()] == [0, 4, 8, None]
    assert [r[0] for r in df.select(is_power_of_two(c("a"))).collect()] == [False, True, False, True, None]
    assert [r[0] for r in df.select(per_second(c("a"), c("b"))).collect()] == [0, 0, 3.5, 8, None]
    assert [r[0] for r in df.select(percent_reduction(c("b"), c("a"))).collect()][:2] == [100.0, 0.0]
