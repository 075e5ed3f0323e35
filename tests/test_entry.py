"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

NAMES = [n for n in entry.oracle_sql() if not n.startswith("op")]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    q = db.execute(entry.oracle_sql()[name])
    named = [d[0] for d in q.description]
    assert sorted(named) == cols
    want = sorted(repr(tuple(r[named.index(c)] for c in cols)) for r in q.fetchall())
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    assert got == want and got
    # an answer that is null everywhere proves nothing
    for c in cols if len(cols) < 12 else ():
        if c not in ("payment_20_extra", "total_payment_sum", "month_rent", "extra_text", "time"):
            assert df.where(f"`{c}` is not null").limit(1).count() == 1, c


def test_entry(spark):
    assert entry.entry(spark).count() > 0
