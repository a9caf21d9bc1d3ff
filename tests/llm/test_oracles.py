import pytest

from lumbre.llm import registry
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, registry.QUERIES[name], registry.ORACLE_SQL[name])


def test_names():
    assert sorted(n.split("_")[0] for n in registry.QUERIES) == sorted(f"op{i}" for i in range(1, 11))
