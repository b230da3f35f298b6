"""Every registered query against its SQL twin."""

import pytest
from compare import differences

from loadgrain.plans.oracles import ORACLES
from loadgrain.plans.registry import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert __spark_entry__.queries().keys() >= __spark_entry__.oracle_sql().keys()
