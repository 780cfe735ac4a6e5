"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import os

import pytest

import __spark_entry__ as registry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


#: The training-data queries have tests of their own.
OWN = list(registry._all())


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.queries()) & set(registry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    same, note = compare(spark, duck, SF, name)
    assert same, note


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in OWN if not n.startswith(("land_", "pipeline_", "stream_", "merge_", "read_", "upsert_gold", "store_"))])
def test_plans_stay_in_the_jvm_and_off_pairwise_joins(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert word not in plan
