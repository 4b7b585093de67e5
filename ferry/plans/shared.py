"""Scheduled table connections (J2): one scan of a source for all of them.

The connections that read one table are run together. Each one's state gives
the rows it takes; the scan filters by what any of them takes (the lowest
stored cursor of each cursor column reaches the files), and one pass writes
every row once for each connection that takes it, partitioned by connection.
That staged table, not the source, is what the strategies read: an append run
or a full override is its partition, renamed into the target; an upsert or a
keyed append merges its partition. Counts and newest cursors of all
connections come from one aggregate over the staged rows. A connection's state
is committed last and on its own, so a run that dies half way is simply run
again: what was staged is left behind unread, and a run or version that no
state names is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.plans import sync
from ferry.session import new_run_dir
from ferry.sinks import snapshot

CONNECTION_COL = "_sync_connection"


class Wanted:
    """One connection's strategy, places and state, and the rows it takes."""

    def __init__(self, connection_id: str, strategy: dict, target: str, state_path: str, prior: dict | None, schema):
        self.connection_id, self.target, self.state_path, self.prior = connection_id, target, state_path, prior
        self.mode, self.cursor, self.keys, self.order_by, self.buckets = (
            strategy.get(k) for k in ("mode", "cursor", "keys", "order_by", "buckets"))
        named = [c for c in (self.cursor, *(self.keys or []), *(self.order_by or [])) if c]
        if missing := [c for c in named if c not in schema.names]:
            raise ValueError(f"the source has no column {missing[0]}")
        self.run = 1 if prior is None else prior["runs"] + 1
        self.buckets = self.buckets if prior is None else prior["buckets"]
        self.cursor_type = schema[self.cursor].dataType if self.cursor else None
        self.stored = None
        if self.cursor and prior is not None and prior["rows_read"] and prior["cursor"] is not None:
            self.stored = F.lit(prior["cursor"]).cast(self.cursor_type)
        self.takes_ties = self.mode == "append" and bool(self.keys) and self.stored is not None

    def condition(self) -> Column | None:
        """The rows of the source to stage (null: all)."""
        return F.col(self.cursor) >= self.stored if self.takes_ties else \
            sync.delta_condition(self.mode, self.cursor, self.prior, self.cursor_type)


def staged(source: DataFrame, wanted: list[Wanted]) -> DataFrame:
    """Each row of the source once for every connection that takes it."""
    conditions = [w.condition() for w in wanted]
    rows = source
    if all(c is not None for c in conditions):
        # the lowest cursor of each column: what the files are asked for
        columns: dict[str, list[Wanted]] = {}
        for w in wanted:
            columns.setdefault(w.cursor, []).append(w)
        rows = source.where(reduce(or_, [_lowest(own) for own in columns.values()]))
    names = [F.when(F.lit(True) if c is None else c, F.lit(w.connection_id)) for w, c in zip(wanted, conditions)]
    taken = F.filter(F.array(*names), lambda x: x.isNotNull())
    return rows.select("*", F.explode(taken).alias(CONNECTION_COL))


def _lowest(wanted: list[Wanted]) -> Column:
    """From the lowest stored cursor of one column on, as a literal, so that
    the filter reaches the scan."""
    c = F.col(wanted[0].cursor)
    if any(w.stored is None for w in wanted):
        return c.isNotNull()
    spark = SparkSession.getActiveSession()
    low = spark.range(1).select(F.array_min(F.array(*[w.stored for w in wanted])).alias("c")).first()["c"]
    return c >= F.lit(low).cast(wanted[0].cursor_type)


def sync_together(source: DataFrame, connections: list[tuple[str, dict, str, str]]) -> list[tuple[str, int | None, str | None]]:
    """Run the connections ``(id, strategy, target, state path)`` of one
    source: one scan, one write, one aggregate, then each connection's target
    and state. Returns ``(id, rows loaded, reason)``; a connection whose
    strategy the source can't serve has a reason and takes no part."""
    spark, done, wanted = source.sparkSession, [], []
    states = {path: {r["connection_id"]: r.asDict() for r in
                     sync.read_state(spark, path).where(F.col("connection_id").isin([c for c, *_ in connections])).collect()}
              for path in {path for *_, path in connections}}
    for connection_id, strategy, target, state_path in connections:
        try:
            wanted.append(Wanted(connection_id, strategy, target, state_path, states[state_path].get(connection_id), source.schema))
        except ValueError as e:
            done.append((connection_id, None, str(e)))
    if not wanted:
        return done
    place = new_run_dir(spark, "shared-scan")
    staged(source, wanted).write.partitionBy(CONNECTION_COL).parquet(place)
    schema = T.StructType([*source.schema.fields, T.StructField(CONNECTION_COL, T.StringType())])
    every = spark.read.schema(schema).parquet(place)
    cursors = sorted({w.cursor for w in wanted if w.cursor})
    counts = {r[CONNECTION_COL]: r for r in every.groupBy(CONNECTION_COL).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).cast("string").alias(f"_max{i}") for i, c in enumerate(cursors)]).collect()}
    fs, _, jvm = snapshot._hadoop_fs(spark, place)
    for w in wanted:
        own = f"{place}/{CONNECTION_COL}={snapshot._escaped(jvm, w.connection_id)}"
        got = counts.get(w.connection_id)
        n = got["_n"] if got else 0
        newest = got[f"_max{cursors.index(w.cursor)}"] if got and w.cursor else None
        delta = spark.read.schema(source.schema).parquet(own) if n else source.limit(0)
        loaded = n
        if w.mode == "upsert":
            loaded = sync.upsert_delta(delta, w.target, w.run, w.keys, w.order_by, w.buckets)
        elif w.takes_ties:
            ties = sync.new_ties(delta, w.target, w.prior["runs"], w.cursor, w.stored, w.keys)
            run = f"{w.target.rstrip('/')}/{sync.RUN_DIR}{w.run}"
            delta.where(F.col(w.cursor) > w.stored).unionByName(ties).write.mode("overwrite").parquet(run)
            n = loaded = spark.read.parquet(run).count()
        else:
            _publish(spark, delta, own if n else None, w)
        sync.commit(spark, w.connection_id, w.state_path, w.prior, w.mode, n, loaded, newest, w.cursor_type, w.buckets)
        done.append((w.connection_id, loaded, None))
    fs.delete(jvm.org.apache.hadoop.fs.Path(place), True)  # every state is committed: nothing reads it any more
    return done


def _publish(spark: SparkSession, delta: DataFrame, own: str | None, w: Wanted) -> None:
    """Make the staged partition the next run (append) or version (full) of
    the target: a rename where both lie in one file system, else a copy."""
    if w.mode == "full":
        newest = max(snapshot._versions(spark, w.target), default=0)
        place = f"{w.target.rstrip('/')}/{snapshot.VERSION_PREFIX}{newest + 1}"
    else:
        place = f"{w.target.rstrip('/')}/{sync.RUN_DIR}{w.run}"
    fs, to, jvm = snapshot._hadoop_fs(spark, place)
    if own is not None:
        own_fs, own_path, _ = snapshot._hadoop_fs(spark, own)
        if own_fs.getUri().equals(fs.getUri()):
            fs.delete(to, True)  # what a run that died left there
            fs.mkdirs(to.getParent())
            if fs.rename(own_path, to):
                fs.create(jvm.org.apache.hadoop.fs.Path(to, "_SUCCESS"), True).close()
                return
    delta.write.mode("overwrite").parquet(place)


def run_sources(spark: SparkSession, plan: DataFrame, read_strategy, table_for, places) -> list[tuple[str, int | None, str | None]]:
    """All table connections of ``plan`` (``connection_id, source_type,
    source, loader, config``; source and loader configs as JSON), source by
    source. Taken from the cluster one source at a time."""
    import json
    done: list[tuple[str, int | None, str | None]] = []

    def run(key, group):
        source_type, text = key
        runnable = []
        for r in group:
            try:
                strategy = read_strategy(r["config"]) or {"mode": "full"}
                runnable.append((r["connection_id"], strategy, *places(json.loads(r["loader"]), r["connection_id"])))
            except ValueError as e:
                done.append((r["connection_id"], None, str(e)))
        if not runnable:
            return
        try:
            source = table_for(source_type)(spark, json.loads(text))
        except AnalysisException as e:
            reason = "source not found" if e.getCondition() == "PATH_NOT_FOUND" else f"source not readable: {e.getCondition()}"
            done.extend((c, None, reason) for c, *_ in runnable)
            return
        done.extend(sync_together(source, runnable))

    group, at = [], None
    for r in plan.orderBy("source_type", "source", "connection_id").toLocalIterator():
        key = (r["source_type"], r["source"])
        if key != at and group:
            run(at, group)
            group = []
        group.append(r)
        at = key
    if group:
        run(at, group)
    return done
