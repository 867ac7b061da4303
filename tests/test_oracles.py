"""Registered queries against their SQL, as the driver compares them, on the smallest tables."""

import math
import os

import duckdb
import pytest

from voltweave.plans.registry import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
NO_SQL = {"boosted_curve", "clean_curve_auto"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float) or hasattr(value, "as_tuple"):
        return "nan" if math.isnan(value) else float(f"{float(value):.9g}")
    return value


def test_all_but_a_few_have_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df, sql = QUERIES[name](spark, DATA), db.sql(ORACLES[name])
    names = sorted(df.columns)
    assert names == sorted(sql.columns)
    mine = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
    theirs = sorted(repr([plain(r[sql.columns.index(c)]) for c in names]) for r in sql.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_others_run(spark, name):
    QUERIES[name](spark, DATA).collect()
