"""Every query with an oracle against DuckDB, and every other query for rows."""

import math
import os

import duckdb
import pytest

from corpusloom.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(table):
    names = sorted(table.column_names)
    return sorted((tuple(plain(r[n]) for n in names) for r in table.to_pylist()), key=lambda r: tuple((v is None, str(v)) for v in r)), names


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, names = rows(QUERIES[name](spark, SF).toArrow())
    if name not in ORACLES:
        assert got
        return
    want, columns = rows(duck.execute(ORACLES[name]).to_arrow_table())
    assert names == columns
    assert len(got) == len(want)
    assert got == want
