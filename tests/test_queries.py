"""Every registered query against its oracle SQL on the smallest driver tables."""

import os

import pytest

from workload import registry
from workload.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(registry.QUERIES) <= set(contract.queries()) and set(registry.ORACLE) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


def _plan(spark, name):
    return registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_plans_stay_in_the_engine(spark, name):
    plan = _plan(spark, name)
    for word in ("Cartesian", "Python", "ArrowEval", "MapInPandas", "Scan ExistingRDD"):
        assert word not in plan


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n.startswith(("import_", "ytd_", "parallel_"))])
def test_imports_are_attached_without_nested_loops(spark, name):
    assert "NestedLoop" not in _plan(spark, name)


def test_range_filters_read_the_source_once(spark):
    assert _plan(spark, "import_range_filters").count("FileScan") == 1


def test_imports_read_once_and_push_down(spark):
    plan = _plan(spark, "import_day_sumfields")
    assert plan.count("FileScan") == 1
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_orderkey" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_parallel_periods_add_no_shuffle(spark):
    facts = _plan(spark, "fact_day_view").count("Exchange hashpartitioning")
    assert _plan(spark, "parallel_week").count("Exchange hashpartitioning") == facts
