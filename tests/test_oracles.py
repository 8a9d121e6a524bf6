"""Every registered query against its SQL twin on the smallest tables."""

import compare
import pytest

import __spark_entry__ as registered

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# Fits need complete windows of both classes, which the smallest tables lack.
FITTED = {"M7_onehot_long", "M9_long_variances", "M10_optimality", "M12_forest_as_tables", "M13_boosted_as_tables", "M13_boosted_leaf_counts", "M14_scores_as_tables"}
QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def cons():
    return {sf: compare.connect(sf) for sf in (SF, LARGER)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, cons, name):
    sf = LARGER if name in FITTED else SF
    df = QUERIES[name](spark, sf)
    assert compare.differences(df, cons[sf], ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    sf = SF if name.startswith("E") else LARGER
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0
