"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import compare
import pytest

from cadastra.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert compare.difference(df, con, ORACLES[name]) is None
    else:
        assert not df.isEmpty()


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["department_code", "id"] or "id" in entry.entry(spark).columns
