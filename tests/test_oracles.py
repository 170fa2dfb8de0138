"""Every registered batch query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from shoplens.operators import visits
from shoplens.plans import oracles, queries, streams
from shoplens.sources import tables
from tests.oracle_check import connect, difference

SF = os.environ.get("SHOPLENS_TEST_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_contract_is_consistent():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    own = {**queries.queries(), **streams.queries()}
    assert set(own) == {*oracles.sql(), *oracles.stream_sql()}


@needs_tables
@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_query_equals_its_sql(spark, db, name):
    ours = queries.queries()[name](spark, SF).toPandas()
    assert difference(ours, db.sql(oracles.sql()[name]).df()) is None


# those whose events come late must show it
ONE_SIDED = {"stream_hot_page_changes": "added", "stream_late_split": "late"}


@needs_tables
@pytest.mark.parametrize("name", sorted(oracles.stream_sql()))
def test_stream_query_equals_its_sql(spark, db, name):
    ours = streams.queries()[name](spark, SF).toPandas()
    assert difference(ours, db.sql(oracles.stream_sql()[name]).df()) is None
    if name in ONE_SIDED:
        assert set(ours[ONE_SIDED[name]]) == {True, False}


@needs_tables
def test_sketches_are_close_to_the_exact_counts(spark, db):
    sketched = visits.uv_hll(tables.user_behavior(spark, SF), per_window=True).toPandas().set_index("window_end")["count"]
    exact = queries.queries()["uv_exact"](spark, SF).toPandas().set_index("window_end")["count"]
    assert ((sketched - exact).abs() / exact).max() < 0.05


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).columns == ["item_id", "window_end", "cnt", "row_num"]
