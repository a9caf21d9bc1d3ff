import importlib.util

import pytest

from lumbre import queries as core
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, core.queries()[name], core.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(core.queries()) == set(core.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1500
    assert set(core.queries()) <= set(e.queries())
    there = importlib.util.find_spec("lumbre.llm") is not None and importlib.util.find_spec("lumbre.llm.registry") is not None
    assert there == any(n.startswith("op1_") for n in e.queries())
