"""Every query that has SQL gives DuckDB's rows."""

import datetime
import decimal
import os
from collections import Counter

import duckdb
import pytest

from changeloom.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_rows(spark, con, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    out = con.execute(registry.ORACLES[name])
    names = [x[0] for x in out.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in out.fetchall())
    assert got
