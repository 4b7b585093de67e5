"""The same operators with broadcasts disabled: the shuffled join paths are
what runs when a side is above the row bound, so they must agree."""

import pytest

from ferry.operators import queue as q
from ferry.operators import strategies as st
from ferry.plans import catalog
from ferry.plans.sizing import MAX_ROWS_CONF

from conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set(MAX_ROWS_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset(MAX_ROWS_CONF)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["until_end", "connection_resolve", "connection_rejects", "json_load"])
def test_query_same_without_broadcast(spark, name):
    want = _rows(catalog.QUERIES[name](spark, SF_SMALL))
    spark.conf.set(MAX_ROWS_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = _rows(df)
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
    assert got == want
    if name != "json_load":  # json_load returns a read of what it wrote
        assert "BroadcastHashJoin" not in plan


def test_hot_queue_until_end_shuffled(spark, no_broadcast):
    # one queue holds a third of the rows; its marker is late
    rows = [("hot", i, i == 900) for i in range(1000)] + [(f"q{i % 50}", i, i % 7 == 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "queue string, seq long, IsEnd boolean")
    got = q.until_end(df)
    assert got.where("queue = 'hot'").count() == 900
    want = sum(1 for i in range(2000) if all(j % 7 != 0 for j in range(i % 50, i + 1, 50)))
    assert got.where("queue != 'hot'").count() == want


def test_incremental_by_connection_shuffled(spark, no_broadcast):
    df = spark.createDataFrame([("c1", 1), ("c1", 5), ("c2", 1), ("c3", 2)], "connection_id string, cur long")
    state = spark.createDataFrame([("c1", 3), ("c2", 1)], "connection_id string, cursor long")
    got = sorted(tuple(r) for r in st.incremental_by_connection(df, state, "cur").collect())
    assert got == [("c1", 5), ("c3", 2)]
