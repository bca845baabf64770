"""Every named query against its reference SQL on the sample tables."""

import re

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from contract import oracle, queries as catalog

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_reference_sql():
    assert set(NAMES) == set(oracle.oracle_sql())
    assert set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, sf_dir, con):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|InPandas|CartesianProduct|NestedLoop", plan)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
