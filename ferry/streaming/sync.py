"""Queue draining with Structured Streaming (H1-H3).

A landing directory of JSON lines is the queue. ``drain`` reads what is
there now and stops (``availableNow``); the checkpoint records which files
were consumed, so a second run adds nothing (H2: exactly once instead of
the reference's auto-ack at-most-once). End markers are dropped rather than
obeyed: each run gets its own landing directory, so nothing after a marker
can belong to another run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q
from ferry.operators import strategies as st
from ferry.plans.sizing import broadcast_if_small
from ferry.sinks import snapshot
from ferry.sources.queue_source import LINE_SCHEMA

# A drain ends when its input ends; a caller may set a limit.
DEFAULT_TIMEOUT_S: int | None = None
# Bound on one micro-batch, so a large backlog drains in steps.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000
INGEST_COL = "_ingested_at"


def read_queue_stream(spark: SparkSession, landing_dir: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return q.parse_messages(reader.text(landing_dir))


def _loaded_rows(parsed: DataFrame) -> DataFrame:
    """Good, non-marker messages as the loader writes them."""
    rows = q.good(parsed).where(~F.col("IsEnd"))
    return rows.select(
        "connection_id", "queue", "seq", env.drop_payload(), "metadata",
        "created_at", "updated_at", env.stringify("data").alias("stringified_data"), "IsEnd")


def drain(spark: SparkSession, landing_dir: str, sink_dir: str, quarantine_dir: str,
          checkpoint_dir: str, timeout_s: int | None = DEFAULT_TIMEOUT_S,
          max_files_per_trigger: int = DEFAULT_MAX_FILES_PER_TRIGGER,
          state_path: str | None = None, ends_path: str | None = None) -> None:
    """H1 + H2: load every message now in ``landing_dir``, then stop.

    Each micro-batch writes its loaded rows and its rejects into
    ``batch=<id>`` directories with overwrite, so a batch replayed after a
    failure rewrites the same files instead of adding duplicates. With
    ``state_path`` the batch's per-connection cursor (latest ``created_at``)
    and row count are stored as its partial state (K6), folded when read; a
    replay finds its partial state there and is not counted twice.

    With ``ends_path`` end markers are obeyed across micro-batches (G1 on a
    stream): each batch stores its own first marker of each queue, and rows at or after it - in this batch or any
    later one - are not loaded. Without it markers are simply dropped.
    """
    parsed = read_queue_stream(spark, landing_dir, max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            loaded = _loaded_rows(batch) if ends_path is None else \
                _loaded_before_end(batch, ends_path, batch_id)
            (loaded.write.mode("overwrite").options(**env.JSON_WRITE_OPTIONS)
             .partitionBy("connection_id").json(f"{sink_dir}/batch={batch_id}"))
            (q.rejects(batch).write.mode("overwrite")
             .json(f"{quarantine_dir}/batch={batch_id}"))
            if state_path is not None:
                fold_state(loaded, state_path, batch_id)
        finally:
            batch.unpersist()

    query = (parsed.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    _await(query, timeout_s)


def drain_dedup(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint_dir: str,
                keys: list[str], watermark: str = "1 hour", event_time: str | None = None,
                timeout_s: int | None = DEFAULT_TIMEOUT_S,
                max_files_per_trigger: int = DEFAULT_MAX_FILES_PER_TRIGGER,
                quarantine_dir: str | None = None) -> None:
    """H3: drop messages already seen with the same keys within the
    watermark delay (state is bounded by the watermark), then load them to a
    file sink. ``keys`` e.g. ``["connection_id", "queue", "seq"]``.

    By default the watermark runs on ingest time (the micro-batch time):
    it never goes back, so no message is ever late and none is dropped -
    copies are caught when they arrive within ``watermark`` of each other.
    With ``event_time`` (e.g. ``created_at``) copies are matched by event
    time instead, and Spark drops rows older than the watermark: use it only
    when producers' clocks and backlog order bound the lateness.

    Malformed lines go to ``quarantine_dir`` (default ``<sink_dir>_rejects``)
    by a second drain of the same landing directory with its own checkpoint.
    """
    rejected = q.rejects(read_queue_stream(spark, landing_dir, max_files_per_trigger))
    rows = _loaded_rows(read_queue_stream(spark, landing_dir, max_files_per_trigger))
    if event_time is None:
        rows = rows.withColumn(INGEST_COL, F.current_timestamp())
        deduped = (rows.withWatermark(INGEST_COL, watermark)
                   .dropDuplicatesWithinWatermark(keys).drop(INGEST_COL))
    else:
        deduped = rows.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    query = (deduped.writeStream.format("json").options(**env.JSON_WRITE_OPTIONS)
             .option("checkpointLocation", checkpoint_dir).option("path", sink_dir)
             .outputMode("append").trigger(availableNow=True).start())
    _await(query, timeout_s)
    query = (rejected.writeStream.format("json")
             .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}_rejects")
             .option("path", quarantine_dir or f"{sink_dir.rstrip('/')}_rejects")
             .outputMode("append").trigger(availableNow=True).start())
    _await(query, timeout_s)


ENDS_SCHEMA = "connection_id string, queue string, end_seq bigint, batch_id bigint"
STREAM_STATE_SCHEMA = "connection_id string, cursor timestamp, rows_read bigint, batch_id bigint"


def _read_partials(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The partial rows of every batch below ``path``."""
    fs, root, _ = snapshot._hadoop_fs(spark, path)
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write_partial(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the batch's partial rows, unless a run before a failure has
    completed that write: a replay changes nothing."""
    place = f"{path.rstrip('/')}/batch_id={batch_id}"
    fs, done, _ = snapshot._hadoop_fs(rows.sparkSession, f"{place}/_SUCCESS")
    if not fs.exists(done):
        rows.write.mode("overwrite").parquet(place)


def read_ends(spark: SparkSession, ends_path: str, up_to: int | None = None) -> DataFrame:
    """The first marker of each queue over all batches (or up to one)."""
    ends = _read_partials(spark, ends_path, ENDS_SCHEMA)
    if up_to is not None:
        ends = ends.where(F.col("batch_id") <= up_to)
    return ends.groupBy("connection_id", "queue").agg(F.min("end_seq").alias("end_seq"),
                                                      F.max("batch_id").alias("batch_id"))


def _loaded_before_end(batch: DataFrame, ends_path: str, batch_id: int) -> DataFrame:
    """G1 across micro-batches: store this batch's first markers, then keep
    the rows before the first marker of their queue in any batch so far."""
    good = q.good(batch)
    _write_partial(good.where(F.col("IsEnd")).groupBy("connection_id", "queue")
                   .agg(F.min("seq").alias("end_seq")), ends_path, batch_id)
    ends = read_ends(batch.sparkSession, ends_path, batch_id).select(
        F.col("connection_id").alias("_c"), F.col("queue").alias("_q"), "end_seq")
    cond = good["connection_id"].eqNullSafe(F.col("_c")) & good["queue"].eqNullSafe(F.col("_q"))
    kept = (good.join(broadcast_if_small(ends), cond, "left")
            .where(~F.col("IsEnd") & (F.col("end_seq").isNull() | (F.col("seq") < F.col("end_seq")))))
    return kept.select(
        "connection_id", "queue", "seq", env.drop_payload(), "metadata",
        "created_at", "updated_at", env.stringify("data").alias("stringified_data"), "IsEnd")


def read_stream_state(spark: SparkSession, state_path: str) -> DataFrame:
    """Per connection the latest cursor, the rows of all batches and the last
    batch: the partial states folded."""
    return (_read_partials(spark, state_path, STREAM_STATE_SCHEMA).groupBy("connection_id")
            .agg(F.max("cursor").alias("cursor"), F.sum("rows_read").alias("rows_read"),
                 F.max("batch_id").alias("batch_id")))


def fold_state(loaded: DataFrame, state_path: str, batch_id: int) -> None:
    """K6 per micro-batch: store the batch's own cursor and row count per
    connection; ``read_stream_state`` folds them."""
    _write_partial(st.sync_state(loaded, ["connection_id"], "created_at"), state_path, batch_id)


def _await(query, timeout_s: int | None) -> None:
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query did not drain within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
