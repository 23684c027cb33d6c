"""Every query with SQL gives the same rows in both engines on the smallest tables."""

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import REGISTRY
from conftest import SF


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    assert difference(spark, duck, name, SF) is None


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
