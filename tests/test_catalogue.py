"""Every registered query against its DuckDB oracle SQL on the sf0.001 tables."""

import datetime as dt
import decimal
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from casegrid.plans.analogues import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# the training-data queries say themselves which of them SQL can express
OWN = sorted(k for k in E.queries() if k != "pipeline" and not re.match(r"op\d+_", k))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "agreement_rate" in df.columns


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert digest([tuple(r) for r in sdf.collect()], sdf.columns) == digest(cur.fetchall(), ocols)
