"""Streams by key and in order: upserts, dedup without a horizon, reordering;
replayed batches change nothing."""

import glob
import json
import os
import random

from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q
from ferry.plans import sync
from ferry.session import local_path
from ferry.sinks import json_loader, queue_sink
from ferry.streaming import keyed, ordered

MESSAGE = "connection_id string, queue string, seq long, data string, at timestamp, end boolean"


def _publish(spark, landing, rows, files=1):
    """rows: (queue, seq, data[, end])"""
    rows = [("c", r[0], r[1], r[2], None, len(r) > 3 and r[3]) for r in rows]
    df = spark.createDataFrame(rows, MESSAGE).repartition(files)
    msgs = env.build_messages(df, env.to_payload("data"), "s", "d", F.col("connection_id"), F.col("queue"), F.col("seq"),
                              created_at=F.lit("2024-01-01").cast("timestamp"), keep=["end"])
    queue_sink.publish(msgs.withColumn("IsEnd", F.col("end")).drop("end"), landing)


def _replay_last(checkpoint):
    """Forget that the last batch was committed: the next drain runs it again."""
    done = sorted(glob.glob(local_path(checkpoint) + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for p in (done[-1], os.path.join(os.path.dirname(done[-1]), f".{os.path.basename(done[-1])}.crc")):
        if os.path.exists(p):
            os.remove(p)


# -------------------------------------------------------------------- upserts
def _row(k, v, t):
    return json.dumps({"k": k, "v": v, "t": t})


def test_stream_upsert(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(f"k{rng.randrange(9)}" if i % 10 else None, i, rng.randrange(50)) for i in range(120)]
    rng.shuffle(rows)
    place = {k: f"{tmp_dir}/{k}" for k in ("landing", "target", "state", "checkpoint", "quarantine")}

    def drain(files=1):
        keyed.drain_upsert(spark, place["landing"], "c", place["target"], place["state"], place["checkpoint"], place["quarantine"],
                           keys=["k"], order_by=["t", "v"], row_schema="k string, v long, t long", buckets=3, max_files_per_trigger=files)

    def held():
        return sorted((tuple(r) for r in sync.read_upserted(spark, place["target"], place["state"], "c").select("k", "v", "t").collect()), key=repr)

    def latest(rows):
        best = {}
        for k, v, t in rows:
            best[k] = max(best.get(k, (t, v)), (t, v))
        return sorted(((k, v, t) for k, (t, v) in best.items()), key=repr)

    _publish(spark, place["landing"], [("q", i, _row(*r)) for i, r in enumerate(rows[:60])] + [("q", 900, "not a row"), ("q", 901, "{}", True)], 3)
    drain()  # several batches of one file
    assert held() == latest(rows[:60])
    before = sync.connection_state(spark, place["state"], "c")
    assert before["rows_read"] == 60 and before["runs"] == before["batch_id"] + 1 > 1
    _replay_last(place["checkpoint"])
    drain()
    assert sync.connection_state(spark, place["state"], "c") == before and held() == latest(rows[:60])
    _publish(spark, place["landing"], [("q", i, _row(*r)) for i, r in enumerate(rows[30:])])
    drain()
    assert held() == latest(rows)
    bad = spark.read.json(place["quarantine"]).select("raw", "reason").collect()
    assert [tuple(r) for r in bad] == [("not a row", keyed.ROW_REJECT)]
    # a stream started anew over the same target: its batch 0 is no replay
    place["checkpoint"] += "-new"
    place["landing"] += "-new"
    _publish(spark, place["landing"], [("q", 0, _row("fresh", 1, 1))])
    drain()
    assert ("fresh", 1, 1) in held() and len(held()) == len(latest(rows)) + 1
    # a table sync goes on from the stream's target
    src = spark.createDataFrame([("fresh", 5, 99)], "k string, v long, t long")
    sync.sync_table(spark, src, "c", place["target"], place["state"], "upsert", cursor="t", keys=["k"], order_by=["t", "v"])
    assert ("fresh", 5, 99) in held()


def test_upsert_batch_that_died(spark, tmp_dir, monkeypatch):
    place = {k: f"{tmp_dir}/{k}" for k in ("landing", "target", "state", "checkpoint", "quarantine")}
    args = (spark, place["landing"], "c", place["target"], place["state"], place["checkpoint"], place["quarantine"])
    how = dict(keys=["k"], order_by=["t"], row_schema="k string, v long, t long", buckets=2)
    real = sync.commit
    for part in ([("a", 1, 1), ("b", 1, 1)], [("a", 2, 2), ("c", 1, 1)]):
        _publish(spark, place["landing"], [("q", i, _row(*r)) for i, r in enumerate(part)])

        def dies(*a):
            raise RuntimeError("lost")
        monkeypatch.setattr(sync, "commit", dies)  # data written, state not
        try:
            keyed.drain_upsert(*args, **how)
            raise AssertionError("should have failed")
        except Exception as e:  # noqa: BLE001
            assert "lost" in str(e)
        monkeypatch.setattr(sync, "commit", real)
        keyed.drain_upsert(*args, **how)
    got = sync.read_upserted(spark, place["target"], place["state"], "c").collect()
    assert sorted(tuple(r) for r in got) == [("a", 2, 2), ("b", 1, 1), ("c", 1, 1)]
    assert sync.connection_state(spark, place["state"], "c")["runs"] == 2


# ------------------------------------------------------- dedup without horizon
def test_dedup_without_a_horizon(spark, tmp_dir):
    place = {k: f"{tmp_dir}/{k}" for k in ("landing", "sink", "checkpoint", "seen", "quarantine")}

    def drain():
        keyed.drain_unseen(spark, place["landing"], place["sink"], place["checkpoint"], place["seen"], place["quarantine"],
                           keys=["connection_id", "queue", "seq"], max_files_per_trigger=2, fold_after=2)

    def loaded():
        rows = json_loader.read_back(spark, place["sink"]).collect()
        return sorted(((r["queue"], r["seq"], r["stringified_data"]) for r in rows), key=repr)

    every = [(f"q{i % 4}" if i % 9 else None, i, f"text {i}") for i in range(40)]
    expected = sorted(((a, b, c) for a, b, c in every), key=repr)
    _publish(spark, place["landing"], every[:25] + every[:5], 3)
    drain()
    assert loaded() == sorted(expected_of(every[:25]), key=repr)
    for _ in range(3):  # copies in later drains, with folds in between
        _publish(spark, place["landing"], every, 2)
        drain()
        assert loaded() == expected
    _replay_last(place["checkpoint"])
    drain()
    assert loaded() == expected
    assert glob.glob(f"{tmp_dir}/seen/folded/version=*/_SUCCESS")  # put together along the way
    # a stream with another checkpoint knows what the first one has loaded
    place["checkpoint"] += "-new"
    _publish(spark, place["landing"], [("q9", 99, "new")])
    drain()
    assert loaded() == sorted([*expected, ("q9", 99, "new")], key=repr)


def expected_of(rows):
    return [(a, b, c) for a, b, c in rows]


def test_seen_keys_read_the_touched_buckets(spark, tmp_dir):
    index = keyed.SeenKeys(spark, f"{tmp_dir}/seen", "k long", "s")
    for b in range(3):
        keys = spark.range(b * 100, b * 100 + 100).select(F.col("id").alias("k"), (F.col("id") % 8).cast("int").alias(keyed.BUCKET))
        index.add(keys, b)
    some = index.read(2, [3])
    assert {r["k"] % 8 for r in some.collect()} == {3} and some.count() == 25  # batch 2 is not its own past
    plan = some._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [") == plan.count("FileScan") > 0 and "PartitionFilters: []" not in plan
    assert not index.fold(2, 3) and index.fold(3, 3)
    assert index.read(3).count() == 300 and index.read(3, [0, 1]).count() == 76


# ------------------------------------------------------------------ reordering
def test_unbroken_runs(spark):
    rows = [("c", "a", s) for s in (0, 1, 2, 5)] + [("c", "b", s) for s in (3, 4, 7)] + [("c", "late", 1)] + [(None, None, 0), ("c", None, 0)]
    nexts = spark.createDataFrame([("c", "b", 3)], "connection_id string, queue string, next_seq long")
    got = ordered.unbroken(spark.createDataFrame(rows, "connection_id string, queue string, seq long"), nexts)
    assert {(r["connection_id"], r["queue"]): r["upto"] for r in got.collect()} == {("c", "a"): 2, ("c", "b"): 4, (None, None): 0, ("c", None): 0}


def test_drain_in_order(spark, tmp_dir):
    rng = random.Random(3)
    place = {k: f"{tmp_dir}/{k}" for k in ("landing", "sink", "quarantine", "checkpoint", "buffer")}
    sizes, ends = {"a": 30, "b": 12, None: 8, "hot": 200}, {"a": 17, "hot": 190}
    every = [(name, s, f"{name}:{s}", ends.get(name) == s) for name, n in sizes.items() for s in range(n)]
    rng.shuffle(every)

    def drain():
        ordered.drain_in_order(spark, *(place[k] for k in ("landing", "sink", "quarantine", "checkpoint", "buffer")))

    def loaded():
        rows = json_loader.read_back(spark, place["sink"]).collect()
        assert all(r["stringified_data"] == f"{r['queue']}:{r['seq']}" and not r["IsEnd"] for r in rows)
        return sorted(((r["queue"], r["seq"]) for r in rows), key=repr)

    def released(arrived):
        out = []
        for name in sizes:
            have, s = {x[1] for x in arrived if x[0] == name}, 0
            while s in have and ends.get(name) != s:
                out.append((name, s))
                s += 1
        return sorted(out, key=repr)

    cuts = [0, 60, 130, 200, len(every)]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        _publish(spark, place["landing"], every[lo:hi] + every[max(0, lo - 9):lo] + [("a", None, "a:None")] * (i == 0))
        drain()
        assert loaded() == released(every[:hi])
        if i in (1, 2):
            _replay_last(place["checkpoint"])
            drain()
            assert loaded() == released(every[:hi])
    assert ordered.waiting(spark, place["buffer"], place["checkpoint"]).count() == 0
    bad = [r["reason"] for r in spark.read.json(place["quarantine"]).collect()]
    assert bad == [ordered.NO_SEQ]
    # the same as the cut over the whole queue at once
    df = spark.createDataFrame(every, "queue string, seq long, data string, IsEnd boolean")
    assert loaded() == sorted(((r["queue"], r["seq"]) for r in q.until_end(df).collect()), key=repr)
    _publish(spark, place["landing"], [("b", 14, "b:14"), ("a", 30, "a:30")])  # behind a gap; of an ended queue
    drain()
    assert [(r["queue"], r["seq"]) for r in ordered.waiting(spark, place["buffer"], place["checkpoint"]).collect()] == [("b", 14)]
