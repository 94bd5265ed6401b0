import pytest

import __spark_entry__ as contract
from compare import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"

#: Queries of the pipeline layers; those on training data are tested with their operators.
NAMES = [name for registry in contract._REGISTRIES for name in registry.queries]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(contract.queries())
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    problem = mismatch(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name])
    assert problem is None, problem
