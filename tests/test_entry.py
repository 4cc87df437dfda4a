import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tokenyard.session import TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "freq"]
    assert df.count() > 0


OWN = sorted(E.QUERIES)  # without those of the optional subpackage


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(OWN) >= 30


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(_norm(row[i]) for i in idx) for row in cur.fetchall())
    assert got == want
