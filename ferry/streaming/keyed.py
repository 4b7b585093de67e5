"""Streams by key: upserts (K5 on a queue) and dedup without a horizon (H3).

Both run their micro-batches through ``foreachBatch`` and know a batch by the
stream's own id (from its checkpoint) and number, so that a batch that is
replayed after a failure changes nothing, and a stream started anew over an
old target, with numbers from 0 again, is not taken for a replay.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q
from ferry.operators import strategies as st
from ferry.plans import sync
from ferry.sinks import snapshot
from ferry.streaming import sync as streams

ROW_REJECT = "malformed row"
#: Hash buckets of the seen keys, and batches after which they are put together.
SEEN_BUCKETS, FOLD_AFTER = 64, 16
BUCKET = "_bucket"


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return json.loads(spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").first()["value"])["id"]


def payload_rows(messages: DataFrame, row_schema: str, options: dict | None = None) -> DataFrame:
    """Messages whose payload is a row as JSON: the row's columns, and
    ``_reject`` (null when good) with the payload's text in ``_raw``."""
    corrupt = env.CORRUPT_COL
    parsed = messages.select(env.stringify("data").alias("_raw")).select("_raw", F.from_json(
        "_raw", f"{row_schema}, {corrupt} string", {"columnNameOfCorruptRecord": corrupt, **(options or {})}).alias("_r"))
    bad = F.col("_r").isNull() | F.col(f"_r.{corrupt}").isNotNull()
    names = [f for f in parsed.schema["_r"].dataType.names if f != corrupt]
    return parsed.select(*[F.col("_r")[n].alias(n) for n in names], "_raw", F.when(bad, F.lit(ROW_REJECT)).alias("_reject"))


def drain_upsert(spark: SparkSession, landing_dir: str, connection_id: str, target: str, state_path: str,
                 checkpoint_dir: str, quarantine_dir: str, keys: list[str], order_by: list[str], row_schema: str,
                 cursor: str | None = None, buckets: int = 16, options: dict | None = None,
                 timeout_s: int | None = streams.DEFAULT_TIMEOUT_S,
                 max_files_per_trigger: int = streams.DEFAULT_MAX_FILES_PER_TRIGGER) -> None:
    """Upsert the rows now in ``landing_dir`` (payloads: rows as JSON of
    ``row_schema``) into a K5 target, then stop. Each micro-batch is one run
    of the target: its latest row of every key is merged into the hash buckets
    that it touches, and the state, with the batch's number, is written last.
    A batch that the state has is skipped; one that died half way is merged
    again from the runs before it. Rows may come in any order and more than
    once: the target holds the latest by ``order_by`` of all rows so far.
    Lines and payloads that can't be read go to ``quarantine_dir``. Read the
    target with ``plans.sync.read_upserted``; a table sync can go on from it.
    """
    parsed = streams.read_queue_stream(spark, landing_dir, max_files_per_trigger)
    cursor = cursor or order_by[0]

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = stream_id(session, checkpoint_dir)
        prior = sync.connection_state(session, state_path, connection_id)
        if prior is not None and prior.get("stream") == stream and prior["batch_id"] >= batch_id:
            return
        batch.persist()
        try:
            rows = payload_rows(q.good(batch).where(~F.col("IsEnd")), row_schema, options)
            rejected = rows.where(F.col("_reject").isNotNull()).select(F.col("_raw").alias("raw"), F.col("_reject").alias("reason"))
            (q.rejects(batch).unionByName(rejected).write.mode("overwrite")
             .json(f"{quarantine_dir}/stream={stream}/batch={batch_id}"))
            rows = rows.where(F.col("_reject").isNull()).drop("_raw", "_reject")
            run = 1 if prior is None else prior["runs"] + 1
            fixed = buckets if prior is None else prior["buckets"]
            seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(cursor).cast("string").alias("c")).first()
            loaded = sync.upsert_delta(rows, target, run, keys, order_by, fixed)
            sync.commit(session, connection_id, state_path, prior, "upsert", seen["n"], loaded, seen["c"],
                        rows.schema[cursor].dataType, fixed, stream, batch_id)
        finally:
            batch.unpersist()

    streams._await(parsed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
                   .trigger(availableNow=True).start(), timeout_s)


class SeenKeys:
    """The keys that streams have loaded, in hash buckets on shared storage.

    A batch's new keys are one directory, written with overwrite. From time
    to time a stream puts its batches together with what was put together
    before, as a new complete version, and then removes what that replaced.
    Only batches before the one that is running are put together: those are
    committed, so a replayed batch never meets its own keys."""

    def __init__(self, spark: SparkSession, path: str, schema: str, stream: str):
        self.spark, self.path, self.schema, self.stream = spark, path.rstrip("/"), f"{schema}, {BUCKET} int", stream

    def _batches(self, before: int | None) -> list[str]:
        """Directories of all streams' batches; of this stream those before ``before``."""
        fs, root, jvm = snapshot._hadoop_fs(self.spark, f"{self.path}/new")
        out = []
        for s in fs.listStatus(root) if fs.exists(root) else []:
            own = s.getPath().getName() == f"stream={self.stream}"
            for b in fs.listStatus(s.getPath()):
                done = fs.exists(jvm.org.apache.hadoop.fs.Path(b.getPath(), "_SUCCESS"))
                if done and (not own or before is None or int(b.getPath().getName().split("=")[1]) < before):
                    out.append((own, b.getPath().toString()))
        return sorted(out)

    def read(self, before: int, touched: list[int] | None = None) -> DataFrame:
        """The keys seen before this stream's batch ``before``, in the touched buckets."""
        places = [p for _, p in self._batches(before)]
        folded = snapshot.current_version(self.spark, f"{self.path}/folded")
        out = self.spark.createDataFrame([], self.schema)
        for place in [*places, *([folded] if folded else [])]:
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(place))
        return out if touched is None else out.where(F.col(BUCKET).isin(touched))

    def add(self, keys: DataFrame, batch_id: int) -> None:
        (keys.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET)
         .parquet(f"{self.path}/new/stream={self.stream}/batch={batch_id}"))

    def fold(self, before: int, after: int = FOLD_AFTER) -> bool:
        """Put this stream's batches before ``before`` together if there are ``after`` of them."""
        own = [p for mine, p in self._batches(before) if mine]
        if len(own) < after:
            return False
        folded = snapshot.current_version(self.spark, f"{self.path}/folded")
        every = [self.spark.read.schema(self.schema).parquet(p) for p in [*own, *([folded] if folded else [])]]
        joined = every[0]
        for more in every[1:]:
            joined = joined.unionByName(more)
        newest = max(snapshot._versions(self.spark, f"{self.path}/folded"), default=0)
        (joined.distinct().repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(BUCKET).parquet(f"{self.path}/folded/{snapshot.VERSION_PREFIX}{newest + 1}"))
        fs, _, jvm = snapshot._hadoop_fs(self.spark, self.path)
        for p in own:  # what a crash leaves here is read twice, which changes nothing
            fs.delete(jvm.org.apache.hadoop.fs.Path(p), True)
        snapshot.remove_old_versions(self.spark, f"{self.path}/folded", keep=1)
        return True


def drain_unseen(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint_dir: str, seen_path: str,
                 quarantine_dir: str, keys: list[str], timeout_s: int | None = streams.DEFAULT_TIMEOUT_S,
                 max_files_per_trigger: int = streams.DEFAULT_MAX_FILES_PER_TRIGGER, fold_after: int = FOLD_AFTER) -> None:
    """H3 without a horizon: load messages whose ``keys`` no batch has loaded
    before, however long ago, then stop. Of copies within a batch one is
    loaded (the one with the earliest ``created_at``, then the smallest text).
    The seen keys are an index in hash buckets of shared storage; a batch
    reads the buckets that its keys fall into and anti-joins them by key. Null
    keys are equal to each other."""
    parsed = streams.read_queue_stream(spark, landing_dir, max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        schema = ", ".join(f"{k} {batch.schema[k].dataType.simpleString()}" for k in keys)
        stream = stream_id(session, checkpoint_dir)
        index = SeenKeys(session, seen_path, schema, stream)
        index.fold(batch_id, fold_after)
        batch.persist()
        try:
            rows = streams._loaded_rows(batch)
            named = [c for c in rows.columns if c not in keys]
            one = rows.groupBy(*keys).agg(F.min(F.struct("created_at", "stringified_data", F.struct(*named).alias("r"))).alias("m"))
            one = one.select(*[F.col(c) if c in keys else F.col(f"m.r.{c}").alias(c) for c in rows.columns],
                             F.pmod(F.xxhash64(*keys), F.lit(SEEN_BUCKETS)).cast("int").alias(BUCKET))
            touched = [r[0] for r in one.select(BUCKET).distinct().collect()]  # at most SEEN_BUCKETS
            seen = index.read(batch_id, touched).select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col(BUCKET).alias("_sb"))
            same = one[BUCKET] == seen["_sb"]
            for i, k in enumerate(keys):
                same = same & one[k].eqNullSafe(seen[f"_s{i}"])
            new = one.join(seen, same, "left_anti")
            place = f"{sink_dir}/stream={stream}/batch={batch_id}"
            (new.drop(BUCKET).write.mode("overwrite").options(**env.JSON_WRITE_OPTIONS)
             .partitionBy("connection_id").json(place))
            index.add(new.select(*keys, BUCKET), batch_id)
            q.rejects(batch).write.mode("overwrite").json(f"{quarantine_dir}/stream={stream}/batch={batch_id}")
        finally:
            batch.unpersist()

    streams._await(parsed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
                   .trigger(availableNow=True).start(), timeout_s)
