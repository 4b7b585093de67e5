"""Physical care points over every registered query."""

import pytest

import __spark_entry__ as E
from ferry.plans import catalog
from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "SinglePartition",
             "BatchEvalPython"]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_forbidden_nodes(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


@pytest.mark.parametrize("name", ["extract_chunks", "envelope_json", "page_source", "config_parse",
                                  "map_chunks", "file_chunks", "incremental_append"])
def test_row_local_queries_do_not_hash_shuffle(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["connection_resolve", "options_map", "connector_lookup", "until_end"])
def test_lookups_broadcast(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["dedup_latest", "dedup_exact"])
def test_dedup_one_shuffle_with_partial_aggregation(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_" in plan
