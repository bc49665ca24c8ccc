"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from wareflow.plans import catalog as _catalog
from scripts.check_oracle import TABLES, digest

SF_DIR = os.environ.get("WAREFLOW_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(_catalog.queries())


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(_catalog.oracle_sql()) == set(NAMES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(ocols, want)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"net", "bulky", "watch"} <= set(df.columns) and "l_discount" not in df.columns
