"""Every named query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from gleanset.plans.catalog import all_queries
from gleanset.plans.oracles import all_oracles

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    link = duckdb.connect()
    for path in SF.glob("*.parquet"):
        link.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return link


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == [
        "batch", "rank", "post_id", "created_utc", "matched_pain_keywords", "matched_tools",
    ]


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, db, name):
    frame = all_queries()[name](spark, str(SF))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    columns = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    cursor = db.execute(all_oracles()[name])
    head = [d[0] for d in cursor.description]
    assert sorted(head) == columns
    spots = [head.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in spots) for r in cursor.fetchall()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            same = math.isclose(x, y, rel_tol=1e-12) if isinstance(x, float) and y is not None else x == y
            assert same, (a, b)
