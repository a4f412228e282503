"""Every registered place query runs and equals its SQL at the smallest size."""

import os

import duckdb
import pytest

from placeforge.plans import queries, source_queries, workflow_queries  # noqa: F401  (they register their queries)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    def one(v):
        return float(v) if isinstance(v, int | float) and not isinstance(v, bool) else None if v is None else str(v)

    return sorted(([one(v) for v in r] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, oracle, name):
    got = queries.QUERIES[name](spark, SF)
    rows = got.collect()
    if name in queries.SQL:
        want = oracle.sql(queries.SQL[name])
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(got.columns)
        mine = plain([[r[c] for c in order] for r in rows])
        at = [want.columns.index(c) for c in order]
        assert mine == plain([[r[i] for i in at] for r in want.fetchall()])
