"""The queries of the subpackage that SQL can express, on the smallest tables."""

import os

import pytest

from shoplens.llm import oracles, registry
from tests.oracle_check import connect, difference

SF = os.environ.get("SHOPLENS_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_query_equals_its_sql(spark, db, name):
    ours = registry.queries()[name](spark, SF).toPandas()
    assert difference(ours, db.sql(oracles.sql()[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(oracles.sql()) <= set(registry.queries())
    assert {name.split("_")[0] for name in registry.queries() if name != "pipeline"} == {f"op{n}" for n in range(1, 14)}
