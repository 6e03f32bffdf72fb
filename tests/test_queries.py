"""Every registered query: plan shape, and exact agreement with its oracle SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import database, difference
from checks.oracles import ORACLES
from checks.registry import QUERIES

# python workers, cartesian products and joins without a key have no place in any plan
UNWANTED = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin")



@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert not UNWANTED.findall(df._jdf.queryExecution().executedPlan().toString())
    assert difference(df, con, ORACLES[name]) is None
