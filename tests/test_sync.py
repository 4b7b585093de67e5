import pytest
from pyspark.sql import functions as F

from ferry.operators import strategies as st
from ferry.plans.sync import connection_state, read_appended, sync_table
from ferry.session import new_run_dir
from ferry.sinks import snapshot

SCHEMA = "id long, k string, cur long, v string"


def _src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_append_runs_and_crash_rerun(spark):
    root = new_run_dir(spark, "t-sync-append")
    target, state = f"{root}/t", f"{root}/s"
    first = _src(spark, [(1, "a", 1, "x"), (2, "b", 2, "y")])
    rep = sync_table(spark, first, "c1", target, state, "append", "cur").first()
    assert (rep["run"], rep["rows_loaded"], rep["cursor"]) == (1, 2, "2")
    # a run that died after writing its data but before the state: same run
    # number, partial output present
    later = _src(spark, [(1, "a", 1, "x"), (2, "b", 2, "y"), (3, "a", 3, "z"), (4, "c", 4, "w")])
    later.where("cur = 3").write.parquet(f"{target}/run=2")
    assert read_appended(spark, target, state, "c1").count() == 2  # uncommitted run not visible
    rep = sync_table(spark, later, "c1", target, state, "append", "cur").first()
    assert (rep["run"], rep["rows_loaded"], rep["cursor"]) == (2, 2, "4")
    got = sorted(r["id"] for r in read_appended(spark, target, state, "c1").collect())
    assert got == [1, 2, 3, 4]
    # nothing new: cursor stays, zero rows
    rep = sync_table(spark, later, "c1", target, state, "append", "cur").first()
    assert (rep["rows_loaded"], rep["cursor"]) == (0, "4")
    assert connection_state(spark, state, "c1")["runs"] == 3


def test_upsert_runs_equal_dedup_of_all(spark):
    root = new_run_dir(spark, "t-sync-upsert")
    target, state = f"{root}/t", f"{root}/s"
    rows = [(i, f"k{i % 4}", i, f"v{i}") for i in range(30)]
    src = _src(spark, rows)
    args = dict(mode="upsert", cursor="cur", keys=["k"], order_by=["cur", "id"])
    sync_table(spark, src.where("cur < 12"), "c1", target, state, **args)
    sync_table(spark, src, "c1", target, state, **args)
    sync_table(spark, src, "c1", target, state, **args)  # re-run: idempotent
    got = sorted(tuple(r) for r in snapshot.read_current(spark, target).collect())
    want = sorted(tuple(r) for r in st.dedup_latest(src, ["k"], ["cur", "id"]).collect())
    assert got == want


def test_full_mode_and_other_connections_untouched(spark):
    root = new_run_dir(spark, "t-sync-full")
    state = f"{root}/s"
    a = _src(spark, [(1, "a", 5, "x")])
    sync_table(spark, a, "ca", f"{root}/ta", state, "full", "cur")
    sync_table(spark, a.withColumn("cur", F.lit(9).cast("long")), "cb", f"{root}/tb", state, "full", "cur")
    sync_table(spark, a.withColumn("v", F.lit("new")), "ca", f"{root}/ta", state, "full", "cur")
    assert snapshot.read_current(spark, f"{root}/ta").first()["v"] == "new"
    assert connection_state(spark, state, "cb")["cursor"] == "9"
    assert connection_state(spark, state, "ca")["runs"] == 2


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        sync_table(spark, _src(spark, []), "c", "/x", "/y", "merge", "cur")


def test_read_state_lists_every_connection(spark):
    from ferry.plans.sync import read_state
    root = new_run_dir(spark, "t-sync-state")
    state = f"{root}/s"
    for cid in ("a", "b"):
        sync_table(spark, _src(spark, [(1, "k", 3, "x")]), cid, f"{root}/t{cid}", state, "full", "cur")
    sync_table(spark, _src(spark, [(1, "k", 5, "x")]), "a", f"{root}/ta", state, "full", "cur")
    got = sorted((r["connection_id"], r["cursor"], r["runs"]) for r in read_state(spark, state).collect())
    assert got == [("a", "5", 2), ("b", "3", 1)]


def test_append_with_keys_keeps_late_ties(spark):
    root = new_run_dir(spark, "t-sync-ties")
    target, state = f"{root}/t", f"{root}/s"
    first = _src(spark, [(1, "a", 1, "x"), (2, "b", 2, "y")])
    sync_table(spark, first, "c1", target, state, "append", "cur", keys=["id"])
    # id 3 has the same cursor as the stored one (2) but arrived late
    later = _src(spark, [(1, "a", 1, "x"), (2, "b", 2, "y"), (3, "c", 2, "late"), (4, "d", 5, "z")])
    rep = sync_table(spark, later, "c1", target, state, "append", "cur", keys=["id"]).first()
    assert rep["rows_loaded"] == 2
    got = sorted(r["id"] for r in read_appended(spark, target, state, "c1").collect())
    assert got == [1, 2, 3, 4]
    # without keys the strict cursor rule applies (documented K2 behaviour)
    root2 = new_run_dir(spark, "t-sync-ties2")
    sync_table(spark, first, "c1", f"{root2}/t", f"{root2}/s", "append", "cur")
    sync_table(spark, later, "c1", f"{root2}/t", f"{root2}/s", "append", "cur")
    assert sorted(r["id"] for r in read_appended(spark, f"{root2}/t", f"{root2}/s", "c1").collect()) == [1, 2, 4]


def test_bucketed_upsert_leaves_other_buckets_alone(spark):
    from ferry.plans.sync import bucket_runs, read_upserted, remove_replaced_buckets
    root = new_run_dir(spark, "t-sync-buckets")
    target, state = f"{root}/t", f"{root}/s"
    src = _src(spark, [(i, f"k{i % 40}", i, f"v{i}") for i in range(200)])
    args = dict(mode="upsert", cursor="cur", keys=["k"], order_by=["cur", "id"], buckets=8)
    rep = sync_table(spark, src, "c1", target, state, **args).first()
    assert (rep["rows_read"], rep["rows_loaded"]) == (200, 40)
    more = src.unionByName(_src(spark, [(500, "k7", 500, "new")]))
    # a run that died after writing data for other keys
    src.selectExpr("*", "3 AS _bucket").write.partitionBy("_bucket").parquet(f"{target}/run=2")
    assert read_upserted(spark, target, state, "c1").count() == 40
    rep = sync_table(spark, more, "c1", target, state, **args).first()
    assert (rep["rows_read"], rep["rows_loaded"]) == (2, 2)  # the row tying the cursor and the new one
    runs = bucket_runs(spark, target, 2)
    assert 1 <= sum(r[-1] == 2 for r in runs.values()) <= 2 < len(runs)
    want = sorted(tuple(r) for r in st.dedup_latest(more, ["k"], ["cur", "id"]).collect())
    assert sorted(tuple(r) for r in read_upserted(spark, target, state, "c1").collect()) == want
    assert remove_replaced_buckets(spark, target, state, "c1") >= 1
    assert sorted(tuple(r) for r in read_upserted(spark, target, state, "c1").collect()) == want


def test_empty_upsert_and_null_keys(spark):
    from ferry.plans.sync import read_upserted
    root = new_run_dir(spark, "t-sync-empty")
    target, state = f"{root}/t", f"{root}/s"
    args = dict(mode="upsert", cursor="cur", keys=["k"], order_by=["cur"], buckets=4)
    rep = sync_table(spark, _src(spark, []), "c1", target, state, **args).first()
    assert (rep["rows_read"], rep["rows_loaded"]) == (0, 0)
    assert read_upserted(spark, target, state, "c1").collect() == []
    rows = [(1, None, 1, "a"), (2, None, 2, "b"), (3, "k", None, "c")]
    sync_table(spark, _src(spark, rows), "c1", target, state, **args)
    assert sorted(r["id"] for r in read_upserted(spark, target, state, "c1").collect()) == [2, 3]


def test_old_versions_can_go(spark):
    target = f"{new_run_dir(spark, 't-versions')}/t"
    for i in range(4):
        snapshot.write_version(_src(spark, [(i, "a", i, "x")]), target)
    assert snapshot.remove_old_versions(spark, target, keep=2) == 2
    assert snapshot.list_versions(spark, target) == [3, 4]
    assert snapshot.read_current(spark, target).first()["id"] == 3


def test_strategy_of_a_connection(spark):
    from ferry.plans.run import read_strategy, read_synced, run_connection, single_connection_registry
    root = new_run_dir(spark, "t-strategy")
    _src(spark, [(1, "a", 1, "x"), (2, "a", 2, "y"), (3, "b", 3, "z")]).write.parquet(f"{root}/src")
    places = ("table_reader", {"url": f"{root}/src"}, "table_loader", {"path": f"{root}/out"})
    for cid, strategy, loaded in (("f", None, 3), ("u", {"mode": "upsert", "cursor": "cur", "keys": ["k"]}, 2)):
        registry = single_connection_registry(spark, cid, *places, config=strategy)
        rep = run_connection(spark, cid, *registry).first()
        assert (rep["read"], rep["loaded"], rep["rejected"]) == (3, loaded, 0)
        assert read_synced(spark, f"{root}/out", cid).count() == loaded
    registry = single_connection_registry(spark, "j", *places[:2], "json_loader", {"path": f"{root}/j"},
                                          config={"mode": "full"})
    with pytest.raises(ValueError, match="does not keep tables"):
        run_connection(spark, "j", *registry)
    for bad in ("[1]", "{", '{"mode": "merge"}', '{"mode": "append"}', '{"mode": "upsert", "cursor": "c"}'):
        with pytest.raises(ValueError):
            read_strategy(bad)
    assert read_strategy(None) == read_strategy("{}") == {}


def test_null_cursors_are_loaded_once(spark):
    """A first run that saw null cursors only is still the first run."""
    for mode, extra in (("append", {}), ("append", {"keys": ["id"]}), ("upsert", {"keys": ["id"], "order_by": ["cur"]})):
        root = new_run_dir(spark, "t-null-cursor")
        target, state = f"{root}/t", f"{root}/s"
        src = _src(spark, [(1, "a", None, "x"), (2, "b", None, "y")])
        read = [sync_table(spark, s, "c1", target, state, mode, cursor="cur", **extra).first()["rows_read"]
                for s in (src, src, _src(spark, [(1, "a", None, "x"), (2, "b", None, "y"), (3, "c", 5, "z")]))]
        assert read == [2, 0, 1]


def test_null_cursors_by_connection(spark):
    from ferry.operators.strategies import incremental_by_connection
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3), ("c", None, 4), ("c", 7, 5), ("c", 9, 6)],
                                 "connection_id string, cur int, id int")
    state = spark.createDataFrame([("a", None), ("c", 7)], "connection_id string, cursor int")
    got = incremental_by_connection(rows, state, "cur")
    assert got.columns == rows.columns and sorted(r["id"] for r in got.collect()) == [2, 3, 6]
