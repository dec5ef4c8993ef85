"""The registered queries of this package against their SQL on the smallest driver tables."""

import duckdb
import pytest

from rowtide.llm.queries import oracle_sql, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_registered_queries():
    names = sorted(queries())
    assert len(names) == 14 and "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))
