from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q
from ferry.session import new_run_dir
from ferry.sinks import json_loader, queue_sink
from ferry.sources import queue_source


def _until_end(spark, rows):
    df = spark.createDataFrame(rows, "queue string, seq long, IsEnd boolean")
    return sorted(((r["queue"], r["seq"]) for r in q.until_end(df).collect()),
                  key=lambda t: (t[0] is not None, t[0] or "", t[1]))


def test_until_end_cases(spark):
    assert _until_end(spark, [("a", 1, False), ("a", 2, False)]) == [("a", 1), ("a", 2)]
    assert _until_end(spark, [("a", 1, False), ("a", 2, True), ("a", 3, False)]) == [("a", 1)]
    # two markers: the first one ends the queue
    assert _until_end(spark, [("a", 1, False), ("a", 3, True), ("a", 2, False), ("a", 5, True),
                              ("a", 4, False)]) == [("a", 1), ("a", 2)]
    # marker first: empty
    assert _until_end(spark, [("a", 1, True), ("a", 2, False)]) == []
    # queues end independently; null queue is one queue; null IsEnd is false
    got = _until_end(spark, [("a", 1, False), ("a", 2, True), ("b", 1, False), ("b", 9, None),
                             (None, 1, False), (None, 2, True), (None, 3, False)])
    assert got == [(None, 1), ("a", 1), ("b", 1), ("b", 9)]


def test_until_end_uses_join_not_window(spark):
    df = spark.createDataFrame([("a", 1, False)], "queue string, seq long, IsEnd boolean")
    plan = q.until_end(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan


def test_publish_consume_round_trip(spark):
    df = spark.createDataFrame([(i, f"q{i % 3}", f"payload-{i}".encode()) for i in range(20)],
                               "i long, qn string, p binary")
    msgs = env.build_messages(df, data=F.col("p"), source="s", destination="d",
                              connection_id="c1", queue=F.col("qn"), seq=F.col("i"))
    landing = new_run_dir(spark, "t-queue")
    queue_sink.publish(msgs, landing)
    back = q.good(queue_source.consume(spark, landing)).collect()
    assert sorted((r["queue"], r["seq"], bytes(r["data"])) for r in back) == \
        sorted((f"q{i % 3}", i, f"payload-{i}".encode()) for i in range(20))


def test_json_loader_stops_at_marker_and_drops_bytes(spark):
    df = spark.createDataFrame([(1, b"a", False), (2, b"b", False), (3, None, True), (4, b"d", False)],
                               "i long, p binary, e boolean")
    msgs = env.build_messages(df, data=F.col("p"), source="s", destination="d",
                              connection_id="c1", queue="q", seq=F.col("i"), keep=["e"]) \
        .withColumn("IsEnd", F.col("e")).drop("e")
    out = new_run_dir(spark, "t-load")
    json_loader.load(msgs, out)
    rows = sorted(json_loader.read_back(spark, out).collect(), key=lambda r: r["seq"])
    assert [(r["seq"], r["stringified_data"], r["data"]) for r in rows] == [(1, "a", None), (2, "b", None)]
    assert rows[0]["connection_id"] == "c1"
    # NDJSON keeps the null payload key
    raw = spark.read.text(out).first()["value"]
    assert '"data":null' in raw


def test_until_end_skips_join_without_markers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "queue string, seq long").withColumn("IsEnd", F.lit(False))
    out = q.until_end(df)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 2


def test_consume_one_queue_prunes_buckets(spark):
    df = spark.createDataFrame([(i, f"q{i % 40}", b"x") for i in range(200)], "i long, qn string, p binary")
    msgs = env.build_messages(df, data=F.col("p"), source="s", destination="d",
                              connection_id="c1", queue=F.col("qn"), seq=F.col("i"))
    landing = new_run_dir(spark, "t-bucket")
    queue_sink.publish(msgs, landing, buckets=4)
    import glob
    from ferry.session import local_path
    dirs = {p.rsplit("/", 1)[-1] for p in glob.glob(local_path(landing) + "/queue_bucket=*")}
    assert len(dirs) <= 4
    one = queue_source.consume(spark, landing, queue="q7", buckets=4)
    assert sorted(r["seq"] for r in q.good(one).collect()) == [i for i in range(200) if i % 40 == 7]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(queue_bucket" in plan
