"""Every registered query against SQL over the same files."""

import __spark_entry__ as contract
import pytest
from compare import connect, differences
from lakeloom import queries as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duck, ORACLES[name]) == []


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
