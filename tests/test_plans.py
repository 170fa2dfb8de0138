"""What the physical plans must look like, whatever the data size."""

import os

import pytest

from shoplens.plans import queries

SF = os.environ.get("SHOPLENS_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

WRITES_FILES = {"source_lines", "source_multi_lines"}
# windows without a partition key over a digest: one row per hour, one per group of ranges
SINGLE_TASK_DIGEST = {"uv_hll", "late_page_views", "salted_counts",
                      "hot_page_counts_in_time", "hot_pages_top_n_in_time"}  # the running maximum of late_page_views


def plan(spark, name):
    return queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["hot_items_top_n", "hot_items_sql", "hot_pages_top_n", "ad_clicks_capped", "ad_blacklist"])
def test_rank_limits_apply_before_the_exchange(spark, name):
    text = plan(spark, name)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2


def test_no_pairing_joins_and_no_python(spark):
    for name in set(queries.queries()) - WRITES_FILES:
        text = plan(spark, name)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, name


def test_only_digests_meet_in_one_task(spark):
    for name in set(queries.queries()) - WRITES_FILES - SINGLE_TASK_DIGEST:
        assert "Exchange SinglePartition" not in plan(spark, name), name


def test_scans_read_what_the_query_needs(spark):
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan(spark, "hot_item_counts")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan(spark, "pv_tumbling")


def test_sliding_counts_shuffle_panes_and_expand_after(spark):
    text = plan(spark, "hot_page_counts")
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("explode(sequence(at") < text.index("REPARTITION_BY_COL") < text.index("partial_count")
