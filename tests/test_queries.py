"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__
from tablewright.catalogue import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(x):
    return round(x, 6) if isinstance(x, float) else x.isoformat() if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got, want = QUERIES[name](spark, FOLDER), db.sql(ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    theirs = sorted((tuple(map(plain, r)) for r in want.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["c_mktsegment", "n", "total"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_anti_missing_looks_at_orders_of_any_price(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (3,), (None,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 500000.0), (2, 10.0), (2, 20.0), (None, 5.0)], "o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert {r[0] for r in QUERIES["anti_missing"](spark, str(tmp_path)).collect()} == {3, None}
