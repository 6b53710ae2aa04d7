"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from segloom.plans.catalogue import ORACLES, QUERIES

ROOT = os.environ.get("SEGLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(ROOT).is_dir(), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(ROOT).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, ROOT)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() >= 0


def test_no_nested_loop_join_and_filters_reach_the_scan(spark):
    for name in ("asof_backward", "interval_overlap_join", "nearest_snap", "range_match", "ngram_contamination"):
        plan = QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name
    plan = QUERIES["completed_episodes"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan


def test_receipts_of_more_journals_than_four_digits_number(spark, tmp_path):
    spark.range(10_012).selectExpr("id AS l_suppkey", "id % 7 AS l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = Counter(c.execute(ORACLES["receipt_bundle"]).fetchall())
    assert Counter(tuple(r) for r in QUERIES["receipt_bundle"](spark, str(tmp_path)).collect()) == want
