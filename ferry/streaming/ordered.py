"""Queues that arrive out of order, taken in order (G1 on a stream).

A queue's messages are numbered without gaps. A message that arrives before
the ones in front of it waits in a buffer on shared storage until the gap
closes; what is released is a queue's unbroken run from its next number on,
so an end marker cuts every message behind it, whichever batch they came in.

The end of the unbroken run is found by joins and aggregates, not by sorting
a queue in one task: a message without a successor ends a run, and the run
that starts with the next number ends at the smallest such end. Sides of one
row a queue are joined as they are: Spark broadcasts them where they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q
from ferry.plans.sizing import materialize
from ferry.sinks import snapshot
from ferry.streaming import sync as streams
from ferry.streaming.keyed import stream_id

NO_SEQ = "message without a number"
QUEUE = ("connection_id", "queue")
NEXT_SCHEMA = "connection_id string, queue string, next_seq bigint, ended boolean"
ROW_COLUMNS = (*QUEUE, "seq", "data", "metadata", "created_at", "updated_at", "stringified_data", "IsEnd")


def _same(left: DataFrame, right: DataFrame, *more: Column) -> Column:
    """The same queue, null names being names; right: ``_c`` and ``_q``."""
    out = left["connection_id"].eqNullSafe(right["_c"]) & left["queue"].eqNullSafe(right["_q"])
    for m in more:
        out = out & m
    return out


def _keyed(df: DataFrame, *columns) -> DataFrame:
    return df.select(F.col("connection_id").alias("_c"), F.col("queue").alias("_q"), *columns)


def unbroken(waiting: DataFrame, nexts: DataFrame, first_seq: int = 0) -> DataFrame:
    """``(connection_id, queue, upto)``: per queue the last number of the run
    without a gap that starts with the queue's next number; queues whose next
    number is still missing have no row. ``nexts``: ``(connection_id, queue,
    next_seq)``; a queue that it doesn't have starts with ``first_seq``."""
    before = _keyed(waiting, (F.col("seq") - 1).alias("_s"))
    ends = waiting.join(before, _same(waiting, before, waiting["seq"] == before["_s"]), "left_anti")
    runs = (waiting.select(*QUEUE, F.col("seq").alias("_first"), F.lit(None).cast("long").alias("_end"))
            .unionByName(ends.select(*QUEUE, F.lit(None).cast("long").alias("_first"), F.col("seq").alias("_end")))
            .groupBy(*QUEUE).agg(F.min("_first").alias("_first"), F.min("_end").alias("upto")))
    side = _keyed(nexts, "next_seq")
    due = F.coalesce("next_seq", F.lit(first_seq))
    return runs.join(side, _same(runs, side), "left").where(F.col("_first") == due).select(*QUEUE, "upto")


def drain_in_order(spark: SparkSession, landing_dir: str, sink_dir: str, quarantine_dir: str, checkpoint_dir: str,
                   buffer_dir: str, first_seq: int = 0, timeout_s: int | None = streams.DEFAULT_TIMEOUT_S,
                   max_files_per_trigger: int = streams.DEFAULT_MAX_FILES_PER_TRIGGER) -> None:
    """Load what is in ``landing_dir`` now, every queue in the order of
    ``seq`` from ``first_seq`` on and up to its first end marker, then stop.
    Messages behind a gap wait below ``buffer_dir``, also for later drains
    with the same checkpoint; ``waiting`` shows them. A message that comes
    again, or for a queue that has ended, is not loaded. Each batch writes its
    rows, its buffer and its queues' next numbers under its own number, with
    overwrite, and reads those of earlier batches only, so a replay rewrites
    the same."""
    parsed = streams.read_queue_stream(spark, landing_dir, max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = stream_id(session, checkpoint_dir)
        place = f"{buffer_dir.rstrip('/')}/stream={stream}"
        batch.persist()
        try:
            good = q.good(batch)
            lost = good.where(F.col("seq").isNull()).select(F.to_json(F.struct(*ROW_COLUMNS)).alias("raw"), F.lit(NO_SEQ).alias("reason"))
            (q.rejects(batch).unionByName(lost).write.mode("overwrite").json(f"{quarantine_dir}/stream={stream}/batch={batch_id}"))
            nexts = _nexts(session, place, batch_id)
            arrived = good.where(F.col("seq").isNotNull()).select(*ROW_COLUMNS)
            rows = arrived.unionByName(_buffered(session, place, batch_id - 1, arrived.schema))
            side = _keyed(nexts, "next_seq", "ended")
            rows = rows.join(side, _same(rows, side), "left").where(
                ~F.coalesce("ended", F.lit(False)) & (F.col("seq") >= F.coalesce("next_seq", F.lit(first_seq)))).select(*ROW_COLUMNS)
            # of a message that came more than once, one (a marker if any is)
            others = [c for c in ROW_COLUMNS if c not in (*QUEUE, "seq")]
            rows = rows.groupBy(*QUEUE, "seq").agg(F.max(F.struct("IsEnd", *[c for c in others if c != "IsEnd"])).alias("m"))
            rows = materialize(rows.select(*QUEUE, "seq", *[F.col(f"m.{c}").alias(c) for c in others]), "in-order")
            upto = materialize(unbroken(rows.select(*QUEUE, "seq"), nexts, first_seq), "unbroken")
            side = _keyed(upto, "upto")
            rows = rows.join(side, _same(rows, side), "left").withColumn("_free", F.coalesce(F.col("seq") <= F.col("upto"), F.lit(False)))
            ends = rows.where(F.col("_free") & F.col("IsEnd")).groupBy(*QUEUE).agg(F.min("seq").alias("end_seq"))
            side = ends.select(F.col("connection_id").alias("_ec"), F.col("queue").alias("_eq"), "end_seq")
            rows = rows.join(side, rows["connection_id"].eqNullSafe(side["_ec"]) & rows["queue"].eqNullSafe(side["_eq"]), "left")
            free = rows.where(F.col("_free") & (F.col("end_seq").isNull() | (F.col("seq") < F.col("end_seq"))))
            (free.select(*QUEUE, "seq", env.drop_payload(), "metadata", "created_at", "updated_at",
                         env.stringify("data").alias("stringified_data"), "IsEnd")
             .write.mode("overwrite").options(**env.JSON_WRITE_OPTIONS).partitionBy("connection_id")
             .json(f"{sink_dir}/stream={stream}/batch={batch_id}"))
            rows.where(~F.col("_free") & F.col("end_seq").isNull()).select(*ROW_COLUMNS) \
                .write.mode("overwrite").parquet(f"{place}/waiting/batch={batch_id}")
            side = _keyed(ends, F.lit(True).alias("ended"))
            (upto.join(side, _same(upto, side), "left")
             .select(*QUEUE, (F.col("upto") + 1).alias("next_seq"), F.coalesce("ended", F.lit(False)).alias("ended"))
             .write.mode("overwrite").parquet(f"{place}/next/batch={batch_id}"))
        finally:
            batch.unpersist()

    streams._await(parsed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
                   .trigger(availableNow=True).start(), timeout_s)


def _nexts(spark: SparkSession, place: str, before: int) -> DataFrame:
    """Per queue its next number and whether it has ended, as of batch ``before``."""
    rows = streams._read_partials(spark, f"{place}/next", f"{NEXT_SCHEMA}, batch bigint").where(F.col("batch") < before)
    return rows.groupBy(*QUEUE).agg(F.max("next_seq").alias("next_seq"), F.max("ended").alias("ended"))


def _buffered(spark: SparkSession, place: str, batch_id: int, schema) -> DataFrame:
    fs, root, _ = snapshot._hadoop_fs(spark, f"{place}/waiting/batch={batch_id}")
    return spark.read.schema(schema).parquet(root.toString()) if fs.exists(root) else spark.createDataFrame([], schema)


def waiting(spark: SparkSession, buffer_dir: str, checkpoint_dir: str) -> DataFrame:
    """The messages that wait behind a gap, after the stream's last batch."""
    place = f"{buffer_dir.rstrip('/')}/stream={stream_id(spark, checkpoint_dir)}/waiting"
    fs, root, _ = snapshot._hadoop_fs(spark, place)
    last = max(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root))
    return spark.read.parquet(f"{place}/batch={last}")
