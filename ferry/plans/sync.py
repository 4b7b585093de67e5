"""Table syncs with persisted state (K1, K2, K5 driven by K6).

``sync_table`` runs one sync of one connection: it reads the connection's
state, selects the rows to load for the mode, writes them, and only then
writes the new state. Data first, state last, so a run that dies half way is
simply run again:

* ``full``   (K1) - the source becomes a new immutable target version.
* ``append`` (K2) - rows with ``cursor > state.cursor`` go to the directory
  ``run=<n>`` of this run, written with overwrite; a re-run after a crash has
  the same run number (the state was not advanced) and replaces the partial
  output. Readers take only runs the state has committed (``read_appended``).
  Given row ``keys``, rows *equal* to the stored cursor that are not loaded
  yet are taken too, so a late row tying the cursor is not lost.
* ``upsert`` (K5) - ``dedup_latest(current target ∪ rows with cursor >=
  state.cursor)``; re-running it is idempotent. With ``buckets`` the target is
  laid out in that many hash buckets of the keys, and a run reads and writes
  only the buckets its rows fall into: ``run=<n>/_bucket=<b>`` holds the whole
  bucket as of run n, a reader takes each bucket from its last committed run
  (``read_upserted``). Without ``buckets`` each run writes a new version of
  the whole target (small targets).

``rows_read`` counts the source rows a run took, ``rows_loaded`` the rows it
brought to the target: one per key for ``upsert``, else all rows read.

The state of a connection (cursor as text, counts, the number of committed
runs, for a stream its id and last batch) lives in its own directory ``connection_id=<id>`` as immutable
versions: an update is an atomic switch to a new complete version, touches
one row, and runs of different connections never write the same files.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, ge, gt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferry.operators import strategies as st
from ferry.plans.sizing import materialize
from ferry.sinks import snapshot

MODES = ("full", "append", "upsert")
STATE_SCHEMA = ("connection_id string, mode string, cursor string, rows_read bigint, "
                "rows_loaded bigint, runs bigint, buckets bigint, stream string, batch_id bigint")
REPORT_SCHEMA = ("connection_id string, mode string, run bigint, rows_read bigint, rows_loaded bigint, "
                 "cursor string")
RUN_DIR = "run="
BUCKET_DIR = "_bucket="
SCHEMA_DIR = "schema"
CONNECTION_DIR = "connection_id="


def _state_dir(state_path: str, connection_id: str) -> str:
    return f"{state_path.rstrip('/')}/{CONNECTION_DIR}{snapshot.escaped(connection_id)}"


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The current state row of every connection: one scan of all versions
    (one small file each, visible only when complete), the newest kept."""
    fs, root, _ = snapshot._hadoop_fs(spark, state_path)
    if not fs.exists(root):
        return spark.createDataFrame([], STATE_SCHEMA)
    rows = (spark.read.schema(f"{STATE_SCHEMA}, version string")
            .option("basePath", state_path).parquet(state_path))
    names = [c for c in rows.columns if c != "version"]
    newest = F.max_by(F.struct(*names), F.col("version").cast("long")).alias("_s")
    return rows.groupBy("connection_id").agg(newest).select("_s.*")


def connection_state(spark: SparkSession, state_path: str, connection_id: str) -> dict | None:
    cur = snapshot.current_version(spark, _state_dir(state_path, connection_id))
    if cur is None:
        return None
    row = spark.read.parquet(cur).first()
    return None if row is None else row.asDict()


def read_appended(spark: SparkSession, target: str, state_path: str, connection_id: str) -> DataFrame:
    """The committed rows of an ``append`` target: runs 1..state.runs."""
    state = connection_state(spark, state_path, connection_id)
    runs = 0 if state is None else state["runs"]
    df = spark.read.option("basePath", target).parquet(target)
    return df.where(F.col("run").cast("long") <= F.lit(runs))


def bucket_runs(spark: SparkSession, target: str, runs: int) -> dict[int, list[int]]:
    """The runs up to ``runs`` that wrote each bucket, ascending (a listing of
    directories; the number of buckets is fixed per target)."""
    fs, root, _ = snapshot._hadoop_fs(spark, target)
    found: dict[int, list[int]] = {}
    for run_dir in fs.listStatus(root) if fs.exists(root) else []:
        name = run_dir.getPath().getName()
        if not name.startswith(RUN_DIR) or int(name[len(RUN_DIR):]) > runs:
            continue
        for bucket_dir in fs.listStatus(run_dir.getPath()):
            b = bucket_dir.getPath().getName()
            if b.startswith(BUCKET_DIR):
                found.setdefault(int(b[len(BUCKET_DIR):]), []).append(int(name[len(RUN_DIR):]))
    return {b: sorted(r) for b, r in found.items()}


def _bucket_path(target: str, run: int, bucket: int) -> str:
    return f"{target.rstrip('/')}/{RUN_DIR}{run}/{BUCKET_DIR}{bucket}"


def _read_buckets(spark: SparkSession, target: str, runs: int, only: set[int] | None = None) -> DataFrame:
    paths = [_bucket_path(target, r[-1], b) for b, r in sorted(bucket_runs(spark, target, runs).items())
             if only is None or b in only]
    empty = f"{target.rstrip('/')}/{SCHEMA_DIR}"
    return spark.read.schema(spark.read.parquet(empty).schema).parquet(empty, *paths)


def read_upserted(spark: SparkSession, target: str, state_path: str, connection_id: str) -> DataFrame:
    """The rows of a bucketed ``upsert`` target as of the committed state."""
    state = connection_state(spark, state_path, connection_id)
    if state is None:
        raise FileNotFoundError(f"no committed run of {connection_id}")
    return _read_buckets(spark, target, state["runs"])


def remove_replaced_buckets(spark: SparkSession, target: str, state_path: str, connection_id: str) -> int:
    """Delete buckets that a later committed run replaced; returns how many.
    For a time when nothing reads an older state."""
    state = connection_state(spark, state_path, connection_id)
    fs, _, jvm = snapshot._hadoop_fs(spark, target)
    old = [(b, r) for b, runs in bucket_runs(spark, target, state["runs"] if state else 0).items()
           for r in runs[:-1]]
    for b, r in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_bucket_path(target, r, b)), True)
    return len(old)


def _upsert_buckets(latest: DataFrame, target: str, run: int, keys: list[str], order_by: list[str],
                    buckets: int) -> None:
    """Merge ``latest`` (one row per key, written) into the buckets it touches."""
    spark = latest.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias(BUCKET_DIR[:-1])
    if run == 1:
        latest.limit(0).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{SCHEMA_DIR}")
        merged = latest
    else:  # at most ``buckets`` numbers
        touched = {r[0] for r in latest.select(bucket).distinct().collect()}
        current = _read_buckets(spark, target, run - 1, touched)
        merged = st.dedup_latest(current.unionByName(latest), keys, order_by)
    (merged.select("*", bucket).repartition(BUCKET_DIR[:-1]).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(BUCKET_DIR[:-1])
     .parquet(f"{target.rstrip('/')}/{RUN_DIR}{run}"))


def sync_table(spark: SparkSession, source: DataFrame, connection_id: str, target: str,
               state_path: str, mode: str, cursor: str | None = None, keys: list[str] | None = None,
               order_by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """One sync run; returns ``(connection_id, mode, run, rows_read,
    rows_loaded, cursor)``. ``full`` needs no cursor. ``buckets`` counts for
    the first upsert run of a target; later runs take the stored number."""
    check_strategy(mode, cursor, keys, order_by)
    prior = connection_state(spark, state_path, connection_id)
    run = 1 if prior is None else prior["runs"] + 1
    if prior is not None:
        buckets = prior["buckets"]
    cursor_type = source.schema[cursor].dataType if cursor else None
    prior_cursor = None
    if prior is not None and prior["cursor"] is not None and cursor:
        prior_cursor = F.lit(prior["cursor"]).cast(cursor_type)
    wanted = delta_condition(mode, cursor, prior, cursor_type)
    delta = source if wanted is None else source.where(wanted)

    stats = Observation(f"sync-{connection_id}-{run}")
    newest = F.max(cursor).cast("string") if cursor else F.max(F.lit(None).cast("string"))
    metrics = (F.count(F.lit(1)).alias("n"), newest.alias("max_cursor"))
    n_loaded = None
    if mode == "full":
        snapshot.write_version(source.observe(stats, *metrics), target)
    elif mode == "append":
        if prior_cursor is not None and keys:
            # rows tying the stored cursor that arrived after the last run:
            # take those not loaded yet (only the boundary rows are compared)
            delta = delta.unionByName(new_ties(source, target, prior["runs"], cursor, prior_cursor, keys))
        delta = delta.observe(stats, *metrics)
        delta.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{RUN_DIR}{run}")
    else:
        n_loaded = upsert_delta(delta.observe(stats, *metrics), target, run, keys, order_by, buckets)

    got = stats.get  # empty when Catalyst proved that no row can come
    n_read, new_max = got.get("n", 0), got.get("max_cursor")
    n_loaded = n_read if n_loaded is None else n_loaded
    new_cursor = commit(spark, connection_id, state_path, prior, mode, n_read, n_loaded, new_max, cursor_type, buckets)
    return spark.createDataFrame([(connection_id, mode, run, n_read, n_loaded, new_cursor)], REPORT_SCHEMA)


def delta_condition(mode: str, cursor: str | None, prior: dict | None, cursor_type):
    """The rows that a run takes besides ties (null: all): those from the
    stored cursor on. Null cursors go in the first run that reads rows,
    whether or not that run saw a cursor."""
    if mode == "full" or prior is None or not prior["rows_read"]:
        return None
    if prior["cursor"] is None:
        return F.col(cursor).isNotNull()
    return (gt if mode == "append" else ge)(F.col(cursor), F.lit(prior["cursor"]).cast(cursor_type))


def new_ties(source: DataFrame, target: str, runs: int, cursor: str, stored, keys: list[str]) -> DataFrame:
    """Rows tying the stored cursor that the committed runs of an append
    target don't have (only the boundary rows are compared)."""
    loaded = (source.sparkSession.read.option("basePath", target).parquet(target)
              .where((F.col("run").cast("long") <= F.lit(runs)) & (F.col(cursor) == stored)))
    loaded = loaded.select(*[F.col(k).alias(f"_l{i}") for i, k in enumerate(keys)])
    tying = source.where(F.col(cursor) == stored)
    known = reduce(and_, [tying[k].eqNullSafe(loaded[f"_l{i}"]) for i, k in enumerate(keys)])
    return tying.join(loaded, known, "left_anti")


def upsert_delta(delta: DataFrame, target: str, run: int, keys: list[str], order_by: list[str], buckets: int | None) -> int:
    """Merge a run's rows into an upsert target; returns the keys it brought."""
    spark = delta.sparkSession
    kept = Observation(f"sync-kept-{run}")
    latest = st.dedup_latest(delta, keys, order_by)
    latest = materialize(latest.observe(kept, F.count(F.lit(1)).alias("n")), "sync-delta")
    if buckets:
        _upsert_buckets(latest, target, run, keys, order_by, buckets)
    else:
        current = snapshot.current_version(spark, target)
        merged = latest if current is None else st.dedup_latest(
            spark.read.parquet(current).unionByName(latest), keys, order_by)
        snapshot.write_version(merged, target)
    return kept.get.get("n", 0)


def commit(spark: SparkSession, connection_id: str, state_path: str, prior: dict | None, mode: str, n_read: int,
           n_loaded: int, new_max: str | None, cursor_type, buckets: int | None, stream: str | None = None,
           batch_id: int | None = None) -> str | None:
    """Write a connection's new state, after its data; returns its cursor.
    A stream's run names the stream and its batch."""
    new_cursor = _greatest(prior["cursor"] if prior else None, new_max, cursor_type, spark)
    row = (connection_id, mode, new_cursor, (prior["rows_read"] if prior else 0) + n_read,
           (prior["rows_loaded"] if prior else 0) + n_loaded, (prior["runs"] if prior else 0) + 1, buckets, stream, batch_id)
    snapshot.write_version(_one_row(spark, row), _state_dir(state_path, connection_id))
    return new_cursor


def check_strategy(mode: str, cursor: str | None, keys: list[str] | None, order_by: list[str] | None) -> None:
    """A strategy that can't run raises ``ValueError`` before anything is stored."""
    if mode not in MODES:
        raise ValueError(f"unknown sync mode: {mode}")
    if mode != "full" and not cursor:
        raise ValueError(f"{mode} needs a cursor")
    if mode == "upsert" and not (keys and order_by):
        raise ValueError("upsert needs keys and order_by")


def _greatest(old: str | None, new: str | None, cursor_type, spark) -> str | None:
    """The later of two cursors, compared in the cursor's own type; the
    cursor never moves back and a run without new rows keeps it."""
    if old is None or new is None:
        return new if old is None else old
    r = spark.range(1).select(F.greatest(F.lit(old).cast(cursor_type),
                                         F.lit(new).cast(cursor_type)).cast("string").alias("c")).first()
    return r["c"]


def _one_row(spark: SparkSession, row: tuple) -> DataFrame:
    """The state row as a one-partition DataFrame (one small file per
    version, not one per default slice)."""
    names = [f.strip().split(" ")[0] for f in STATE_SCHEMA.split(",")]
    types = [f.strip().split(" ")[1] for f in STATE_SCHEMA.split(",")]
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)])
