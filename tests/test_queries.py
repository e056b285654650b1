"""Every core query against its SQL on the small tables, as the driver does it."""

from __future__ import annotations

import glob
import math
import os

import pytest

from pairloom.plans import catalog

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    v = v.item() if hasattr(v, "item") else v
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df):
    names = sorted(df.columns)
    df = df[names].astype(object)
    return names, sorted((tuple(plain(x) for x in r) for r in df.where(df.notna(), None).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_more_than_one_shard(spark, duck):
    """The round trip on a table that fills ten shards, place by place."""
    data = "/root/testdata/sf0.01"
    got = catalog.queries()["shard_roundtrip"](spark, data).toPandas()
    assert len(got) >= 3 and got["different"].sum() == 0 and (got.sort_values("shard_id")["equal"][:-1] == 1000).all()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    assert rows(catalog.queries()[name](spark, DATA).toPandas()) == rows(duck.execute(catalog.oracle_sql()[name]).df())
