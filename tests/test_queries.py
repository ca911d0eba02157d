"""Registered queries against their SQL twins on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_contract():
    assert set(oracle_sql()) <= set(queries())
    assert len(oracle_sql()) > 90


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_same_as_sql(spark, con, key):
    df = queries()[key](spark, FOLDER)
    names = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    con.execute(f"CREATE OR REPLACE TEMP TABLE _r AS {oracle_sql()[key]}")
    kinds = {r[0]: r[1] for r in con.execute("DESCRIBE _r").fetchall()}
    assert sorted(kinds) == names
    assert {c: check.KINDS[k] for c, k in kinds.items()} == dict(df.dtypes)
    quoted = ", ".join(f'"{c}"' for c in names)
    assert check.compare(rows, con.execute(f"SELECT {quoted} FROM _r").fetchall()) is None
