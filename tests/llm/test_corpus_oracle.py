"""The queries of the subpackage that have SQL, against DuckDB."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from segloom.llm.registry import ORACLES, QUERIES

ROOT = os.environ.get("SEGLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(ROOT).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for p in Path(ROOT).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    df = QUERIES[name](spark, ROOT)
    cols = sorted(df.columns)
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[names.index(c)] for c in cols) for r in found.fetchall())
