"""The registered queries of this subpackage over the smallest data: against their SQL where they have one."""

import glob
import os
from collections import Counter

import pytest

from anemora.llm.queries import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    import duckdb

    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(map(str, df.select(*cols).collect()))
    if name in ORACLES:
        c = duckdb.connect()
        for f in glob.glob(f"{DATA}/*.parquet"):
            c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        cur = c.execute(f"select {', '.join(cols)} from ({ORACLES[name]})")
        want = Counter(str(tuple(r)) for r in cur.fetchall())
        assert Counter(str(tuple(r)) for r in df.select(*cols).collect()) == want
    assert sum(got.values()) >= 0
