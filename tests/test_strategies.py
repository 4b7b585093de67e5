import datetime as dt

from pyspark.sql import functions as F

from ferry.operators import strategies as st
from ferry.session import new_run_dir
from ferry.sinks import snapshot

SCHEMA = "k string, cur long, tie long, v string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedup_latest_ties_nulls_and_null_keys(spark):
    df = _df(spark, [("a", 1, 1, "x"), ("a", 3, 1, "y"), ("a", 3, 2, "z"),   # tie on cur -> tie desc
                     ("b", None, 5, "n1"), ("b", 2, 0, "b2"),                # null cursor is last
                     ("c", None, 1, "c1"), ("c", None, 2, "c2"),             # all null -> tie desc
                     (None, 1, 1, "u"), (None, 2, 1, "w")])                  # null key = one group
    got = {r["k"]: r["v"] for r in st.dedup_latest(df, ["k"], ["cur", "tie"]).collect()}
    assert got == {"a": "z", "b": "b2", "c": "c2", None: "w"}


def test_dedup_latest_is_idempotent_and_partial(spark):
    rows = [(f"k{i % 7}", i % 11, i, f"v{i}") for i in range(200)]
    df = _df(spark, rows)
    once = st.dedup_latest(df, ["k"], ["cur", "tie"])
    plan = once._jdf.queryExecution().executedPlan().toString()  # before any action
    assert _rows(st.dedup_latest(once, ["k"], ["cur", "tie"])) == _rows(once)
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan  # map-side combine before the shuffle


def test_dedup_exact_keeps_smallest_id(spark):
    df = spark.createDataFrame([(3, "x", "a"), (1, "x", "b"), (2, "y", "c"), (4, None, "d"), (5, None, "e")],
                               "id long, t string, other string")
    got = sorted(tuple(r) for r in st.dedup_exact(df, "t", "id").collect())
    assert got == [(1, "x", "b"), (2, "y", "c"), (4, None, "d")]


def test_incremental_append(spark):
    df = _df(spark, [("a", 1, 0, "x"), ("a", 2, 0, "y"), ("a", None, 0, "n")])
    assert df.count() == st.incremental_append(df, "cur", None).count()  # first sync: all, nulls too
    assert [r["v"] for r in st.incremental_append(df, "cur", 1).collect()] == ["y"]  # strict >
    assert st.incremental_append(df, "cur", 2).count() == 0
    # two steps = one step
    step1 = st.incremental_append(df.where("cur <= 1"), "cur", None).where("cur is not null")
    step2 = st.incremental_append(df, "cur", step1.agg(F.max("cur")).first()[0])
    assert _rows(step1.unionByName(step2)) == _rows(df.where("cur is not null"))


def test_incremental_filter_reaches_scan(spark, tmp_dir):
    spark.range(100).selectExpr("id", "cast(id as timestamp) ts").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    out = st.incremental_append(df, "ts", dt.datetime(1970, 1, 1, 0, 0, 50))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert out.count() == 49


def test_incremental_by_connection(spark):
    df = spark.createDataFrame([("c1", 1), ("c1", 5), ("c2", 1), ("c3", 2)], "connection_id string, cur long")
    state = spark.createDataFrame([("c1", 3), ("c2", 1)], "connection_id string, cursor long")
    got = sorted(tuple(r) for r in st.incremental_by_connection(df, state, "cur").collect())
    assert got == [("c1", 5), ("c3", 2)]


def test_upsert_metamorphic(spark):
    rows = [(f"k{i % 5}", i, i % 3, f"v{i}") for i in range(40)]
    df = _df(spark, rows)
    target = st.dedup_latest(df.where("cur < 20"), ["k"], ["tie", "cur"])
    # empty delta = target
    empty = df.where("false")
    assert _rows(st.upsert(target, empty, ["k"], ["tie", "cur"])) == _rows(target)
    # upsert over a split table = dedup of the whole, boundary row read twice
    up = st.upsert(target, df, ["k"], ["tie", "cur"], cursor="cur", state_cursor=19)
    assert _rows(up) == _rows(st.dedup_latest(df, ["k"], ["tie", "cur"]))


def test_sync_state_fold(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), ("c", None)], "g string, cur long")
    prior = spark.createDataFrame([("a", 9, 4), ("z", 7, 1)], "g string, cursor long, rows_read long")
    got = {r["g"]: (r["cursor"], r["rows_read"]) for r in st.sync_state(df, ["g"], "cur", prior).collect()}
    # the cursor never moves back; groups without new rows keep their state
    assert got == {"a": (9, 6), "b": (2, 1), "c": (None, 1), "z": (7, 1)}
    whole = st.sync_state(df, ["g"], "cur")
    split = st.sync_state(df.where("cur >= 2"), ["g"], "cur", st.sync_state(df.where("not (cur >= 2) or cur is null"), ["g"], "cur"))
    assert _rows(whole) == _rows(split)


def test_full_override_partitions(spark):
    target = new_run_dir(spark, "t-override")
    df = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 3)], "connection_id string, x long")
    snapshot.override_partitions(df, target, ["connection_id"])
    snapshot.override_partitions(spark.createDataFrame([("c1", 9)], "connection_id string, x long"),
                                 target, ["connection_id"])
    got = sorted((r["connection_id"], r["x"]) for r in spark.read.parquet(target).collect())
    assert got == [("c1", 9), ("c2", 3)]  # c1 replaced, c2 untouched


def test_versions_swap(spark):
    target = new_run_dir(spark, "t-versions")
    assert snapshot.current_version(spark, target) is None
    snapshot.write_version(spark.range(3), target)
    snapshot.write_version(spark.range(5), target)
    assert snapshot.list_versions(spark, target) == [1, 2]
    assert snapshot.read_current(spark, target).count() == 5


def test_explicit_version_replaces_incomplete_attempt(spark):
    import os

    from ferry.session import local_path
    target = new_run_dir(spark, "t-version-explicit")
    # an attempt at version 1 that died before committing
    os.makedirs(local_path(target) + "/version=1", exist_ok=True)
    with open(local_path(target) + "/version=1/part-garbage", "w") as f:
        f.write("partial")
    assert snapshot.list_versions(spark, target) == []  # not complete, not visible
    snapshot.write_version(spark.range(4), target, version=1)
    assert snapshot.list_versions(spark, target) == [1]
    assert snapshot.read_current(spark, target).count() == 4
