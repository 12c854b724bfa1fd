"""Every registered time-series query against its SQL on DuckDB."""

import datetime
import os

import duckdb
import numpy as np
import pytest

from tickframe.plans import queries as series

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6) if v == v else None
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def compare(spark, duck, name, queries, oracle):
    df = queries[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted((tuple(plain(v) for v in r) for r in duck.sql(f"select {listed} from ({oracle[name]})").fetchall()), key=repr)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(series.oracle_sql()))
def test_query(spark, duck, name):
    compare(spark, duck, name, series.queries(), series.oracle_sql())


def test_every_query_has_sql():
    assert set(series.queries()) == set(series.oracle_sql())
