"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the driver's smoke entry point."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from ferry.plans import catalog  # noqa: E402
from oracle_check import TABLES, canon  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    sql = E.oracle_sql()[name].replace("/root/testdata/sf0.01/", f"{SF_SMALL}/")
    res = duck.execute(sql)
    d_cols = [c[0] for c in res.description]
    sn, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    dn, dr = canon(d_cols, res.fetchall())
    assert sn == dn
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["connection_id", "read", "loaded", "rejected"]
    assert len(rows) == 1 and rows[0]["loaded"] == rows[0]["read"] > 0
