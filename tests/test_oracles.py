"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
import oracles
from eventmere.plans import catalog
from tools.compare import differences

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_as_sql(spark, name):
    assert differences(spark, FOLDER, name) == ""


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 9
    assert rows[0].dropout_rate == max(r.dropout_rate for r in rows)
