"""Every catalogued query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from ledgerflow import registry
from ledgerflow.plans.standins import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    sql = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(sql.columns)
    own = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    at = [sql.columns.index(c) for c in sorted(sql.columns)]
    assert own == sorted(tuple(plain(r[i]) for i in at) for r in sql.fetchall())
