"""The registry, and the SQL counterparts on the small tables where these exist."""

import os

import pytest

import __spark_entry__ as entry
from conceptmerge.plans import workloads

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps"
).split()


def test_registry():
    assert set(workloads.ORACLES) <= set(workloads.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(workloads.ORACLES))
def test_equals_sql(spark, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = workloads.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.execute(workloads.ORACLES[name]).fetchdf()
    assert sorted(want.columns) == cols
    plain = lambda v: "null" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    rows = lambda df: sorted(tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False))
    assert rows(df.toPandas()) == rows(want)
