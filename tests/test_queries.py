"""Every registered query: contract, plan shape, and equality with its oracle."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from check import norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
#: Run streams or write tables while they are built, or loop on the driver.
ACTIVE = ("stream_", "upsert_", "write_", "batch_files", "link_reachability")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    # Learned models and codecs are tested against brute force in tests/llm.
    assert not [q for q in QUERIES if q not in ORACLES and not re.match(r"op\d+_|pipeline$", q)]
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    if not name.startswith(ACTIVE):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in ORACLES:
        cur = db.execute(ORACLES[name])
        at = [d[0] for d in cur.description]
        assert sorted(at) == cols
        assert got == sorted((tuple(norm(r[at.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
