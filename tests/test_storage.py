from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from pairloom.storage import delete_path, materialize, new_path, shared_dir, spread


def session(master, setting=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_shared_dir():
    assert shared_dir(session("spark://x:7077", "file:///shared/")) == "file:///shared"
    own = shared_dir(session("local[4]"))
    assert os.path.isdir(own) and shared_dir(session("local[4]")) == own != shared_dir(session("local"))
    for master in ("spark://x:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master))


def test_materialize(spark):
    df = spark.range(10).selectExpr("id", "id % 2 as k", "cast(null as string) as n")
    for parts in (None, ["k"]):
        got = materialize(df, "t", parts)
        assert sorted(tuple(r) for r in got.select("id", "n").collect()) == [(i, None) for i in range(10)]
    assert materialize(df.limit(0), "t").count() == 0
    path = new_path(spark, "x")
    df.write.parquet(path)
    delete_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    assert spread(df.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
