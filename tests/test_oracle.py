"""Every registered query with an oracle matches DuckDB at sf0.001."""

import duckdb
import pytest

from netlens.plans.catalog import load_all
from netlens.sources.testdata import TABLES
from tools.oracle_check import rows_key

from .conftest import SF001

REG = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REG.items() if sql))
def test_matches_oracle(spark, con, name):
    fn, sql = REG[name]
    df = fn(spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_key(srows, df.columns) == rows_key(orows, ocols)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    q = E.queries()
    o = E.oracle_sql()
    assert set(o) <= set(q)
