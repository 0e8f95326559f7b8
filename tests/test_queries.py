"""Every named query against its SQL, on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from utterlake.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


#: Rules are learned from more files than the smallest tables have.
LARGER = {"rule_learning": "/root/testdata/sf0.01", "identity_assignment": "/root/testdata/sf0.01"}


def connect(folder):
    c = duckdb.connect()
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    return c


@pytest.fixture(scope="module")
def con():
    return {folder: connect(folder) for folder in {SF, *LARGER.values()}}


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, con, name):
    sql = catalogue.oracle_sql()[name]
    folder = LARGER.get(name, SF)
    df = catalogue.queries()[name](spark, folder)
    cur = con[folder].execute(sql)
    columns, want = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(repr(tuple(map(plain, r))) for r in got) == sorted(repr(tuple(map(plain, r))) for r in want)


def test_entry_without_optional_parts(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns[:2] == ["conv_id", "role"]
    assert set(catalogue.oracle_sql()) <= set(e.oracle_sql()) and set(e.oracle_sql()) <= set(e.queries())
