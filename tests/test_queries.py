"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from rowtide.plans.oracles import oracle_sql
from rowtide.plans.queries import queries
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "value", "segment"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
