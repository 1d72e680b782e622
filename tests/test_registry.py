import pytest

from satlake.plans import registry
from tests.oracle import both, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, sf, con, name):
    ours, theirs = both(registry.QUERIES[name](spark, sf), con, registry.ORACLE_SQL[name])
    assert ours == theirs


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_pushdown(spark, sf):
    """Columns and filters reach the scan."""
    from satlake.plans.ledger import Ledger

    plan = Ledger(spark, sf).spends._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "PushedFilters: [IsNotNull(l_orderkey)]" in plan or "PushedFilters" in plan
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def test_buckets_are_pruned(spark, sf):
    for name in ("partition_scan", "height_range"):
        df = registry.QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(height_bucket" in plan
