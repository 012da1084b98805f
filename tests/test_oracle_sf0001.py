"""Every query with oracle SQL equals DuckDB on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from clinical_cohort.plans import registry  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

registry.load_all()

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert len(srows) == len(drows)
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in dcols)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
