from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.session import new_run_dir
from ferry.sinks import json_loader, queue_sink
from ferry.streaming.sync import drain, drain_dedup


def _messages(spark, ids, queue="q1"):
    df = spark.createDataFrame([(i, f"p{i}".encode()) for i in ids], "i long, p binary")
    return env.build_messages(df, data=F.col("p"), source="s", destination="d", connection_id="c1",
                              queue=queue, seq=F.col("i"), created_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_drain_is_exactly_once_and_quarantines(spark):
    root = new_run_dir(spark, "t-stream")
    landing = f"{root}/landing"
    queue_sink.publish(_messages(spark, range(10)), landing)
    # a broken line in the same queue directory
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{landing}/queue_bucket=0")
    args = (spark, landing, f"{root}/sink", f"{root}/quarantine", f"{root}/ckpt")
    drain(*args)
    back = json_loader.read_back(spark, f"{root}/sink")
    assert sorted(r["seq"] for r in back.collect()) == list(range(10))
    assert {r["stringified_data"] for r in back.collect()} == {f"p{i}" for i in range(10)}
    rej = spark.read.json(f"{root}/quarantine").collect()
    assert [r["reason"] for r in rej] == ["malformed message"]
    # second run over the same landing directory adds nothing
    drain(*args)
    assert json_loader.read_back(spark, f"{root}/sink").count() == 10
    # new files are picked up by the next run, and only they
    queue_sink.publish(_messages(spark, range(10, 15)), landing)
    drain(*args)
    assert json_loader.read_back(spark, f"{root}/sink").count() == 15


def test_drain_drops_end_markers(spark):
    root = new_run_dir(spark, "t-stream-end")
    landing = f"{root}/landing"
    msgs = _messages(spark, range(3))
    marker = spark.range(1).select(*env.end_marker(F.lit("c1"), F.lit("q1"), F.lit(99)))
    queue_sink.publish(msgs.unionByName(marker), landing)
    drain(spark, landing, f"{root}/sink", f"{root}/q", f"{root}/ckpt")
    assert sorted(r["seq"] for r in json_loader.read_back(spark, f"{root}/sink").collect()) == [0, 1, 2]


def test_stream_dedup(spark):
    root = new_run_dir(spark, "t-stream-dedup")
    landing = f"{root}/landing"
    queue_sink.publish(_messages(spark, range(6)), landing)
    queue_sink.publish(_messages(spark, range(3, 9)), landing)  # 3,4,5 sent twice
    drain_dedup(spark, landing, f"{root}/sink", f"{root}/ckpt", keys=["connection_id", "queue", "seq"])
    assert sorted(r["seq"] for r in json_loader.read_back(spark, f"{root}/sink").collect()) == list(range(9))


def test_drain_folds_sync_state_once_per_batch(spark):
    from ferry.streaming.sync import fold_state, read_stream_state
    root = new_run_dir(spark, "t-stream-state")
    landing, state = f"{root}/landing", f"{root}/state"
    queue_sink.publish(_messages(spark, range(4)), landing)
    args = (spark, landing, f"{root}/sink", f"{root}/q", f"{root}/ckpt")
    drain(*args, state_path=state)
    queue_sink.publish(_messages(spark, range(4, 7)), landing)
    drain(*args, state_path=state)
    got = read_stream_state(spark, state).collect()
    assert [(r["connection_id"], r["rows_read"]) for r in got] == [("c1", 7)]
    # replaying an already folded batch changes nothing
    last = got[0]["batch_id"]
    fold_state(json_loader.read_back(spark, f"{root}/sink"), state, last)
    assert read_stream_state(spark, state).first()["rows_read"] == 7


def test_drain_obeys_markers_across_batches(spark):
    from ferry.operators import queue as q
    root = new_run_dir(spark, "t-stream-ends")
    landing, ends = f"{root}/landing", f"{root}/ends"
    args = (spark, landing, f"{root}/sink", f"{root}/q", f"{root}/ckpt")

    def marker(queue, seq):
        return spark.range(1).select(*env.end_marker(F.lit("c1"), F.lit(queue), F.lit(seq)))

    # run 1: q1 rows 0..4 and its marker at 3; q2 rows 0..2, no marker yet
    queue_sink.publish(_messages(spark, range(5), "q1").unionByName(marker("q1", 3))
                       .unionByName(_messages(spark, range(3), "q2")), landing)
    drain(*args, ends_path=ends)
    # run 2: more q1 rows (after its marker), q2 marker at 4 and rows 3..6
    queue_sink.publish(_messages(spark, range(5, 8), "q1").unionByName(marker("q2", 4))
                       .unionByName(_messages(spark, range(3, 7), "q2")), landing)
    drain(*args, ends_path=ends)
    got = sorted((r["queue"], r["seq"]) for r in json_loader.read_back(spark, f"{root}/sink").collect())
    assert got == [("q1", 0), ("q1", 1), ("q1", 2), ("q2", 0), ("q2", 1), ("q2", 2), ("q2", 3)]


def test_stream_dedup_many_batches_out_of_order_keeps_every_row(spark):
    """Copies arrive in later micro-batches with older event times: nothing
    may be dropped as late, and every key is loaded once."""
    import datetime as dt
    root = new_run_dir(spark, "t-stream-dedup-late")
    landing = f"{root}/landing"

    def msgs(ids, day):
        df = spark.createDataFrame([(i, f"p{i}".encode()) for i in ids], "i long, p binary")
        return env.build_messages(df, data=F.col("p"), source="s", destination="d", connection_id="c1",
                                  queue="q1", seq=F.col("i"),
                                  created_at=F.lit(dt.datetime(2024, 1, day)).cast("timestamp"))

    queue_sink.publish(msgs(range(0, 5), 20), landing, buckets=1)    # new events first
    queue_sink.publish(msgs(range(5, 10), 1), landing, buckets=1)    # 19 days older
    queue_sink.publish(msgs(range(0, 10), 1), landing, buckets=1)    # retried copies, old times
    drain_dedup(spark, landing, f"{root}/sink", f"{root}/ckpt", keys=["connection_id", "queue", "seq"],
                max_files_per_trigger=1)
    assert sorted(r["seq"] for r in json_loader.read_back(spark, f"{root}/sink").collect()) == list(range(10))
