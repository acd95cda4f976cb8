"""Every registered query against its SQL over the smallest data; queries without SQL must run and keep their columns."""

import glob
import math
import os
from collections import Counter

import pytest

from anemora import queries as core

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = core.queries(), core.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def same(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(tuple(map(same, r)) for r in df.select(*cols).collect())
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        want = Counter(tuple(same(r[names.index(c)]) for c in cols) for r in cur.fetchall())
        assert got == want
