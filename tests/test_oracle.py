"""Every query of the catalogue against its SQL in DuckDB on a small table set."""

import decimal
import os

import duckdb
import pytest

from tidelog.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(int(v))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("events", "nation", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    found = duck.execute(catalogue.SQL[name])
    names = sorted(c[0] for c in found.description)
    assert sorted(df.columns) == names
    at = [[c[0] for c in found.description].index(n) for n in names]
    assert sorted(tuple(plain(r[n]) for n in names) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
