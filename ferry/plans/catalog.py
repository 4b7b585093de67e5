"""The registered queries: one per operator of the inventory, each a Spark
job over the driver tables, and the DuckDB SQL that must give equal rows.

Every query reads whole tables. Fixed parameters (chunk sizes, the sync
boundary, the connector names) are module constants so both sides use the
same values.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import config as cfg
from ferry.functions import envelope as env
from ferry.operators import chunks as ch
from ferry.operators import queue as q
from ferry.operators import registry as reg
from ferry.operators import strategies as st
from ferry.plans import tables as tb
from ferry.plans.sizing import broadcast_if_small
from ferry.session import configure, new_run_dir
from ferry.sinks import json_loader, queue_sink, snapshot
from ferry.sources import file_chunks as fc
from ferry.sources import queue_source

# Fixed query parameters.
DOC_CHUNK_BYTES = 1024
FILE_CHUNK_BYTES = 1024 * 1024
TEXT_CHUNK_BYTES = 1000
#: Lines of a file that queries write as a source.
LINES_PER_FILE = 500
#: Files of ``file_lines`` at least, the text bytes of one about, and the bytes of a range.
LINE_FILES, LINE_FILE_BYTES, LINE_RANGE_BYTES = 4, 16 * 1024 * 1024, 64 * 1024
SYNC_BOUNDARY = dt.datetime(2024, 1, 15, 0, 0, 0)
OVERRIDDEN = ("click", "view")
#: Hash buckets of an upserted events target.
UPSERT_BUCKETS = 16
EVENTS_CONNECTION = "events"
LOADER_NAME = "json_loader"
#: Rows of events as JSON payloads.
ROW_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EVENT_ROW = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
#: Connections of ``run_scheduled_pages`` by their url prefix.
PAGE_PREFIXES = {"secure": "https://", "plain": "http://", "any": "http", "none": "ftp://"}


def _t(spark, sf_dir, name, spread_rows=False):
    return tb.table(spark, sf_dir, name, spread_rows)


def _event_messages(events: DataFrame, with_markers: bool = False,
                    queue_col: str = "user_id") -> DataFrame:
    """Events as queue messages: connection ``events``, queue = user (or
    ``queue_col``), seq = event id, payload = the ``props`` JSON text, time =
    the event time. With markers, ``error`` events are end markers of their
    queue."""
    msgs = env.build_messages(
        events, data=env.to_payload("props"), source=EVENTS_CONNECTION, destination=LOADER_NAME,
        connection_id=EVENTS_CONNECTION, queue=F.col(queue_col).cast("string"),
        seq=F.col("event_id"), created_at=F.col("ts"), updated_at=F.col("ts"),
        keep=["event_type"] if with_markers else ())
    if with_markers:
        msgs = msgs.withColumn("IsEnd", F.col("event_type") == "error").drop("event_type")
    return msgs


# --------------------------------------------------------------------- A/C
def extract_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: documents cut into 1 KiB byte chunks."""
    docs = _t(spark, sf_dir, "documents")
    chunks = ch.chunk_column(docs, "text", DOC_CHUNK_BYTES, keep=["doc_id"])
    return chunks.select("doc_id", "seq", F.octet_length("data").cast("long").alias("n_bytes"),
                         F.md5("data").alias("data_md5"))


def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 + C4: events as serialised envelopes (payload = event type)."""
    ev = _t(spark, sf_dir, "events")
    msgs = env.build_messages(
        ev, data=env.to_payload("event_type"), source=EVENTS_CONNECTION, destination=LOADER_NAME,
        connection_id=EVENTS_CONNECTION, queue=F.col("user_id").cast("string"),
        seq=F.col("event_id"), created_at=F.col("ts"), updated_at=F.col("ts"), keep=["event_id"])
    return msgs.select("event_id", env.serialize().alias("message"))


def _doc_messages(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    chunks = ch.chunk_column(docs, "text", DOC_CHUNK_BYTES, keep=["doc_id"])
    return env.build_messages(
        chunks, data=F.col("data"), source="documents", destination=LOADER_NAME,
        connection_id="documents", queue=F.col("doc_id").cast("string"), seq=F.col("seq"))


def queue_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 -> C1 -> C2 -> C3 -> reassembly: bytes survive the JSON hop."""
    lines = _doc_messages(spark, sf_dir).select(env.serialize().alias("value"))
    back = q.good(q.parse_messages(lines))
    whole = ch.reassemble(back, ["queue"])
    return whole.select(F.col("queue").cast("long").alias("doc_id"),
                        F.col("n_chunks"),
                        F.octet_length("data").cast("long").alias("n_bytes"),
                        F.md5("data").alias("text_md5"))


def stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 after reassembly: the text comes back unchanged."""
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    chunks = ch.chunk_column(docs, "text", DOC_CHUNK_BYTES, keep=["doc_id"])
    whole = ch.reassemble(chunks, ["doc_id"])
    return whole.select("doc_id", env.stringify("data").alias("text"))


def until_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: per user queue, the events before the first ``error`` marker."""
    ev = _t(spark, sf_dir, "events").select(
        F.col("user_id").alias("queue"), F.col("event_id").alias("seq"),
        (F.col("event_type") == "error").alias("IsEnd"))
    kept = q.until_end(ev)
    return kept.select(F.col("queue").alias("user_id"), F.col("seq").alias("event_id"))


def queue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 + B6: a queue holding the envelopes of all events plus the lines
    of a misconfigured producer that sent raw conversation texts. The strict
    parse keeps every line and labels the foreign ones (loaded + quarantined
    = input)."""
    ev = _event_messages(_t(spark, sf_dir, "events", spread_rows=True))
    good_lines = ev.select(F.lit("events").alias("kind"), F.col("seq").cast("string").alias("key"),
                           env.serialize().alias("value"))
    conv = _t(spark, sf_dir, "conversations", spread_rows=True)
    foreign = conv.select(F.lit("conversations").alias("kind"),
                          F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
                          .alias("key"), F.col("text").alias("value"))
    parsed = q.parse_messages(good_lines.unionByName(foreign), keep=["kind", "key"], strict=True)
    return parsed.select("kind", "key", F.col("_reject").isNull().alias("accepted"),
                         F.col("_reject").alias("reason"))


def page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: fetched pages under ``https://`` as payloads, with byte sizes."""
    from ferry.sources.pages import read_pages
    pages = read_pages(spark, tb.table(spark, sf_dir, "pages"), url_prefix="https://")
    return pages.select("page_id", "url", F.octet_length("data").cast("long").alias("n_bytes"))


def _registry_union(spark, sf_dir):
    s = tb.sources(spark, sf_dir).withColumn("kind", F.lit("source"))
    l_ = tb.loaders(spark, sf_dir).withColumn("kind", F.lit("loader"))
    return s.unionByName(l_)


def config_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 + C9: typed configs and validation errors of every registry row."""
    r = _registry_union(spark, sf_dir)
    p = cfg.parse_config("type", "config")
    return r.select("kind", "id", "type", p["url"].alias("url"), p["path"].alias("path"),
                    p["error"].alias("error"))


def options_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per resolved connection, the option lists handed to the
    source and loader (``KEY=value``, sorted), and the config each side
    rebuilds from them (error when a required option is missing)."""
    res = reg.resolve_connections(tb.connections(spark, sf_dir, spread_rows=True),
                                  tb.sources(spark, sf_dir), tb.loaders(spark, sf_dir))
    base_s = F.create_map(F.lit("CONNECTION_ID"), F.col("connection_id"),
                          F.lit("SOURCE_ID"), F.col("source_id"), F.lit("QUEUE_NAME"), F.col("queue"))
    base_l = F.create_map(F.lit("CONNECTION_ID"), F.col("connection_id"),
                          F.lit("LOADER_ID"), F.col("loader_id"), F.lit("QUEUE_NAME"), F.col("queue"))
    s_env = cfg.merge_options(base_s, cfg.config_to_options("source_type", "source_cfg"))
    l_env = cfg.merge_options(base_l, cfg.config_to_options("loader_type", "loader_cfg"))
    return res.select("connection_id",
                      F.array_join(cfg.options_list(s_env), " ").alias("source_env"),
                      F.array_join(cfg.options_list(l_env), " ").alias("loader_env"),
                      # What the started connector would make of its options
                      cfg.options_to_config("source_type", s_env)["error"].alias("source_check"),
                      cfg.options_to_config("loader_type", l_env)["error"].alias("loader_check"))


def connection_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + C7 + C14: connections joined to their source and loader."""
    res = reg.resolve_connections(tb.connections(spark, sf_dir), tb.sources(spark, sf_dir),
                                  tb.loaders(spark, sf_dir))
    return res.select("connection_id", "source_id", "loader_id", "source_type", "loader_type", "queue")


def connection_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + E2 + D2: only valid registry rows are stored; connections
    pointing elsewhere are rejected with the reference's reason."""
    s_ok = reg.validate_registry(tb.sources(spark, sf_dir), "sources").where(F.col("reason").isNull())
    l_ok = reg.validate_registry(tb.loaders(spark, sf_dir), "loaders").where(F.col("reason").isNull())
    conns = reg.required_check(tb.connections(spark, sf_dir), "connections") \
        .where(F.col("reason").isNull()).drop("reason")
    checked = reg.check_references(conns, s_ok, l_ok)
    return checked.where(F.col("reason").isNotNull()).select("connection_id", "reason")


def connector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: each registry row's type -> connector, or ``unknown type``."""
    r = _registry_union(spark, sf_dir).select("kind", "id", "type")
    return reg.lookup_connector(r).select("kind", "id", "type", "connector", "reason")


def route_sync_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual / scheduled / invalid per connection."""
    conns = tb.connections(spark, sf_dir)
    return reg.route_sync_type(conns).select(F.col("id").alias("connection_id"), "sync_type", "route")


# ----------------------------------------------------------------------- K
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: events after the stored cursor (strict ``>``)."""
    ev = _t(spark, sf_dir, "events")
    return st.incremental_append(ev, "ts", SYNC_BOUNDARY)


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: latest event per user by value, ties by event id."""
    ev = _t(spark, sf_dir, "events")
    return st.dedup_latest(ev, ["user_id"], ["value", "event_id"])


def incremental_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: a target synced up to the boundary, then an upsert of the rows
    at or after its cursor; equals ``dedup_latest`` of the whole table."""
    ev = _t(spark, sf_dir, "events")
    first = ev.where(F.col("ts") < F.lit(SYNC_BOUNDARY).cast("timestamp_ntz"))
    target = st.dedup_latest(first, ["user_id"], ["value", "event_id"])
    state_cursor = first.agg(F.max("ts")).first()[0]
    return st.upsert(target, ev, ["user_id"], ["value", "event_id"], cursor="ts",
                     state_cursor=state_cursor)


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: one document per distinct text, smallest id kept."""
    return st.dedup_exact(_t(spark, sf_dir, "documents"), "text", "doc_id")


def sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: per event type, max cursor and rows read, built as a prior state
    (before the boundary) folded with the next batch."""
    ev = _t(spark, sf_dir, "events")
    b = F.lit(SYNC_BOUNDARY).cast("timestamp_ntz")
    prior = st.sync_state(ev.where(F.col("ts") < b), ["event_type"], "ts")
    return st.sync_state(ev.where(F.col("ts") >= b), ["event_type"], "ts", prior=prior)


def full_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a table of five connections (one per event type); two of them
    are overridden with their current snapshot (events from the boundary
    on), the other three must stay as they were."""
    ev = _t(spark, sf_dir, "events").select(
        F.col("event_type").alias("connection_id"), "event_id", "ts", "user_id", "value", "props")
    target = new_run_dir(spark, "full-override")
    snapshot.override_partitions(ev, target, ["connection_id"])
    fresh = ev.where(F.col("connection_id").isin(*OVERRIDDEN)
                     & (F.col("ts") >= F.lit(SYNC_BOUNDARY).cast("timestamp_ntz")))
    snapshot.override_partitions(fresh, target, ["connection_id"])
    return spark.read.parquet(target).select("connection_id", "event_id", "ts", "user_id", "value", "props")


# ---------------------------------------------------------------- B / H / I
def json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: events through the loader (stop at each queue's end marker,
    stringify, drop bytes) into NDJSON by connection, read back."""
    msgs = _event_messages(_t(spark, sf_dir, "events"), with_markers=True)
    out = new_run_dir(spark, "json-load")
    json_loader.load(msgs, out, chunked=False)  # an event is a payload of its own
    back = json_loader.read_back(spark, out)
    return back.select("connection_id", "queue", "seq", "stringified_data",
                       F.col("metadata.source").alias("source"),
                       F.col("metadata.destination").alias("destination"),
                       F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                       F.col("data").isNull().alias("data_is_null"))


def queue_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + B2 behind a queue: documents cut into 1 KiB chunks, published,
    consumed and loaded as NDJSON. Characters that a cut divided are whole:
    the chunks read back one after the other are the text."""
    landing, out = new_run_dir(spark, "queue-text"), new_run_dir(spark, "queue-text-out")
    queue_sink.publish(_doc_messages(spark, sf_dir), landing)
    json_loader.load(q.good(queue_source.consume(spark, landing)), out)
    back = json_loader.read_back(spark, out).groupBy(F.col("queue").cast("long").alias("doc_id")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "stringified_data"))).alias("_c"))
    return back.select("doc_id", F.size("_c").cast("long").alias("n_chunks"),
                       F.array_join(F.transform("_c", lambda c: c["stringified_data"]), "").alias("text"))


def file_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the table files themselves read as 1 MiB byte chunks."""
    chunks = fc.read_file_chunks(spark, f"{sf_dir.rstrip('/')}/*.parquet", FILE_CHUNK_BYTES)
    return chunks.select(F.element_at(F.split("path", "/"), -1).alias("file"), "seq",
                         F.octet_length("data").cast("long").alias("n_bytes"),
                         F.md5("data").alias("data_md5"))


def _utf8_chars(b: bytes) -> int:
    return len(b.decode("utf-8"))


def map_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A per-chunk function (strict UTF-8 decode, character count) in
    Arrow batches; chunks it fails on are quarantined, not dropped."""
    docs = _t(spark, sf_dir, "documents")
    chunks = ch.chunk_column(docs, "text", DOC_CHUNK_BYTES, keep=["doc_id"])
    out = ch.map_chunks(chunks, _utf8_chars, T.LongType(), keys=["doc_id", "seq"],
                        result_col="n_chars")
    return out.select("doc_id", "seq", "n_chars", F.col("error").isNotNull().alias("quarantined"))


def _publish_events(spark, sf_dir, landing, copies=1):
    """Publish events to a landing directory, one queue per event type.
    With ``copies=2`` every message is sent twice, as an at-least-once
    producer that retries does."""
    msgs = _event_messages(_t(spark, sf_dir, "events", spread_rows=True), queue_col="event_type")
    if copies > 1:
        msgs = msgs.unionByName(msgs)
    queue_sink.publish(msgs, landing)


def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + H2 (+ A3, B1): publish events to a landing queue, drain it with
    an availableNow stream into the loader's NDJSON, read back."""
    from ferry.streaming.sync import drain
    root = new_run_dir(spark, "stream-sync")
    _publish_events(spark, sf_dir, f"{root}/landing")
    drain(spark, f"{root}/landing", f"{root}/sink", f"{root}/quarantine", f"{root}/checkpoint")
    back = json_loader.read_back(spark, f"{root}/sink")
    return back.select("connection_id", "queue", "seq", "stringified_data")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: every message is published twice (an at-least-once producer);
    the stream keeps one copy per (connection, queue, seq)."""
    from ferry.streaming.sync import drain_dedup
    root = new_run_dir(spark, "stream-dedup")
    _publish_events(spark, sf_dir, f"{root}/landing", copies=2)
    drain_dedup(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint",
                keys=["connection_id", "queue", "seq"])
    back = json_loader.read_back(spark, f"{root}/sink")
    return back.select("connection_id", "queue", "seq", "stringified_data")


def stream_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on a stream out of order: each conversation is a queue, its turns
    are numbered from 0, and turns of a multiple of four bytes are end
    markers. The even turns are published and drained first, the odd ones
    after them; every queue still stops at its first marker."""
    from ferry.streaming.ordered import drain_in_order
    conv = _t(spark, sf_dir, "conversations")
    text = env.to_payload(F.coalesce("text", F.lit("")))
    msgs = env.build_messages(conv, data=text, source="conversations", destination=LOADER_NAME, connection_id="conversations",
                              queue=F.col("conv_id").cast("string"), seq=F.col("turn"), created_at=F.lit(SYNC_BOUNDARY))
    msgs = msgs.withColumn("IsEnd", F.octet_length("data") % 4 == 0)
    root = new_run_dir(spark, "stream-reorder")
    for odd in (0, 1):
        queue_sink.publish(msgs.where(F.col("seq") % 2 == odd), f"{root}/landing")
        drain_in_order(spark, f"{root}/landing", f"{root}/sink", f"{root}/quarantine", f"{root}/checkpoint", f"{root}/buffer")
    return json_loader.read_back(spark, f"{root}/sink").select(
        F.col("queue").cast("long").alias("conv_id"), F.col("seq").alias("turn"), F.col("stringified_data").alias("text"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 + K5: events are published as rows in JSON, the later ones first
    and some twice, and drained in two runs into an upsert target by user: the
    latest event of every user, whatever the order of arrival."""
    from ferry.plans.sync import read_upserted
    from ferry.streaming.keyed import drain_upsert
    ev = _t(spark, sf_dir, "events", spread_rows=True)
    whole = F.to_json(F.struct(*ev.columns), {"timestampNTZFormat": ROW_TIME})
    msgs = env.build_messages(ev, data=env.to_payload(whole), source=EVENTS_CONNECTION, destination=LOADER_NAME,
                              connection_id=EVENTS_CONNECTION, queue=F.col("user_id").cast("string"),
                              seq=F.col("event_id"), created_at=F.col("ts"), updated_at=F.col("ts"))
    root = new_run_dir(spark, "stream-upsert")
    b = F.lit(SYNC_BOUNDARY).cast("timestamp")
    early, late = msgs.where(F.col("created_at") < b), msgs.where(F.col("created_at") >= b)
    for part in (late, early.unionByName(late)):
        queue_sink.publish(part, f"{root}/landing")
        drain_upsert(spark, f"{root}/landing", EVENTS_CONNECTION, f"{root}/target", f"{root}/state", f"{root}/checkpoint",
                     f"{root}/quarantine", keys=["user_id"], order_by=["value", "event_id"], row_schema=EVENT_ROW, cursor="ts",
                     buckets=UPSERT_BUCKETS, options={"timestampNTZFormat": ROW_TIME})
    return read_upserted(spark, f"{root}/target", f"{root}/state", EVENTS_CONNECTION)


def stream_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 without a horizon: every message is published in two producer runs,
    drained one after the other with an index of the keys seen; the second
    run's copies, however late, are not loaded again."""
    from ferry.streaming.keyed import drain_unseen
    root = new_run_dir(spark, "stream-dedup-all")
    for copies in (1, 2):
        _publish_events(spark, sf_dir, f"{root}/landing", copies)
        drain_unseen(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint", f"{root}/seen", f"{root}/quarantine",
                     keys=["connection_id", "queue", "seq"])
    return json_loader.read_back(spark, f"{root}/sink").select("connection_id", "queue", "seq", "stringified_data")


def stream_until_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + H1 on a stream: per-user queues whose ``error`` events are end
    markers, published in two producer runs (before / after the boundary)
    and drained twice; markers are obeyed across the two runs."""
    from ferry.streaming.sync import drain
    msgs = _event_messages(_t(spark, sf_dir, "events"), with_markers=True)
    root = new_run_dir(spark, "stream-until-end")
    landing = f"{root}/landing"
    args = (spark, landing, f"{root}/sink", f"{root}/quarantine", f"{root}/checkpoint")
    b = F.lit(SYNC_BOUNDARY).cast("timestamp")
    queue_sink.publish(msgs.where(F.col("created_at") < b), landing)
    drain(*args, ends_path=f"{root}/ends")
    queue_sink.publish(msgs.where(F.col("created_at") >= b), landing)
    drain(*args, ends_path=f"{root}/ends")
    back = json_loader.read_back(spark, f"{root}/sink")
    return back.select("connection_id", "queue", "seq", "stringified_data")


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + K6: five connections (one per event type) publish in two
    producer runs; each run is drained by a stream that folds the
    per-connection cursor and row count."""
    from ferry.streaming.sync import drain, read_stream_state
    ev = _t(spark, sf_dir, "events", spread_rows=True)
    msgs = env.build_messages(
        ev, data=env.to_payload("props"), source=EVENTS_CONNECTION, destination=LOADER_NAME,
        connection_id=F.col("event_type"), queue=F.col("event_type"), seq=F.col("event_id"),
        created_at=F.col("ts"), updated_at=F.col("ts"))
    root = new_run_dir(spark, "stream-state")
    landing, state = f"{root}/landing", f"{root}/state"
    b = F.lit(SYNC_BOUNDARY).cast("timestamp")
    args = (spark, landing, f"{root}/sink", f"{root}/quarantine", f"{root}/checkpoint")
    queue_sink.publish(msgs.where(F.col("created_at") < b), landing)
    drain(*args, state_path=state)
    queue_sink.publish(msgs.where(F.col("created_at") >= b), landing)
    drain(*args, state_path=state)
    return read_stream_state(spark, state).select(
        "connection_id", F.col("cursor").cast("timestamp_ntz").alias("cursor"), "rows_read")


def queue_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 batch: publish events as JSON lines (B1), consume them back."""
    landing = new_run_dir(spark, "queue")
    queue_sink.publish(_event_messages(_t(spark, sf_dir, "events", spread_rows=True),
                                       queue_col="event_type"), landing)
    got = q.good(queue_source.consume(spark, landing))
    return got.select("connection_id", "queue", "seq", env.stringify("data").alias("stringified_data"),
                      F.col("created_at").cast("timestamp_ntz").alias("created_at"))


def queue_consume_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 for one queue: all events are published (one queue per event
    type); the consumer of queue ``click`` reads only that queue's bucket
    directory (partition pruning) and keeps that queue's messages."""
    landing = new_run_dir(spark, "queue-one")
    queue_sink.publish(_event_messages(_t(spark, sf_dir, "events", spread_rows=True),
                                       queue_col="event_type"), landing)
    got = q.good(queue_source.consume(spark, landing, queue="click"))
    return got.select("connection_id", "queue", "seq", env.stringify("data").alias("stringified_data"))


def sync_append_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + K6 with persisted state: a first append run when the source held
    the events before the boundary, a second when it holds them all. The
    committed target has every event once, tagged with its run."""
    from ferry.plans.sync import read_appended, sync_table
    ev = _t(spark, sf_dir, "events")
    root = new_run_dir(spark, "sync-append")
    target, state = f"{root}/target", f"{root}/state"
    b = F.lit(SYNC_BOUNDARY).cast("timestamp_ntz")
    sync_table(spark, ev.where(F.col("ts") < b), EVENTS_CONNECTION, target, state, "append", "ts",
               keys=["event_id"])
    sync_table(spark, ev, EVENTS_CONNECTION, target, state, "append", "ts", keys=["event_id"])
    out = read_appended(spark, target, state, EVENTS_CONNECTION)
    return out.select("event_id", F.col("run").cast("long").alias("run"), "ts", "user_id",
                      "event_type", "value", "props")


def sync_upsert_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + K6 with persisted state: two upsert runs (the source before the
    boundary, then all of it) leave the latest event per user as target, in
    hash buckets of the key."""
    from ferry.plans.sync import read_upserted, sync_table
    ev = _t(spark, sf_dir, "events")
    root = new_run_dir(spark, "sync-upsert")
    target, state = f"{root}/target", f"{root}/state"
    b = F.lit(SYNC_BOUNDARY).cast("timestamp_ntz")
    args = dict(mode="upsert", cursor="ts", keys=["user_id"], order_by=["value", "event_id"],
                buckets=UPSERT_BUCKETS)
    sync_table(spark, ev.where(F.col("ts") < b), EVENTS_CONNECTION, target, state, **args)
    sync_table(spark, ev, EVENTS_CONNECTION, target, state, **args)
    return read_upserted(spark, target, state, EVENTS_CONNECTION)


# ---------------------------------------------------------------------- J
def _run_events(spark, sf_dir, name, strategy):
    """Two runs of a connection from the events table to a table loader, by
    the strategy in its config: the events before the boundary, then all."""
    from ferry.plans.run import read_synced, run_connection, single_connection_registry
    out = new_run_dir(spark, name)
    registry = single_connection_registry(
        spark, EVENTS_CONNECTION, cfg.TABLE_READER, {"url": f"{sf_dir.rstrip('/')}/events.parquet"},
        cfg.TABLE_LOADER, {"path": out}, config=strategy)
    run_connection(spark, EVENTS_CONNECTION, *registry, where=f"ts < timestamp_ntz '{SYNC_BOUNDARY}'")
    run_connection(spark, EVENTS_CONNECTION, *registry)
    return read_synced(spark, out, EVENTS_CONNECTION)


def run_sync_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + K2: the connection's config asks for an incremental append."""
    out = _run_events(spark, sf_dir, "run-sync-append", {"mode": "append", "cursor": "ts", "keys": ["event_id"]})
    return out.select("event_id", F.col("run").cast("long").alias("run"), "ts", "user_id",
                      "event_type", "value", "props")


def run_sync_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + K5: the connection's config asks for an upsert by user."""
    return _run_events(spark, sf_dir, "run-sync-upsert",
                       {"mode": "upsert", "cursor": "ts", "keys": ["user_id"],
                        "order_by": ["value", "event_id"], "buckets": UPSERT_BUCKETS})


def run_scheduled_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 between tables: three scheduled connections read one events table,
    each by its own strategy (append, upsert, full override). Two scheduled
    runs, the second after the table has grown by the events from the boundary
    on; each run scans the table once. Returns what the targets hold."""
    import json

    from ferry.plans.run import read_synced
    from ferry.plans.run import run_scheduled as run_all
    source, out = new_run_dir(spark, "run-tables-source"), new_run_dir(spark, "run-tables")
    strategies = {"all": {"mode": "full"}, "by-user": {"mode": "upsert", "cursor": "ts", "keys": ["user_id"],
                                                       "order_by": ["value", "event_id"], "buckets": UPSERT_BUCKETS},
                  "log": {"mode": "append", "cursor": "ts"}}
    sources = spark.createDataFrame([("events", "events", cfg.TABLE_READER, json.dumps({"url": source}))],
                                    "id string, name string, type string, config string")
    loaders = spark.createDataFrame([("out", "tables", cfg.TABLE_LOADER, json.dumps({"path": out}))],
                                    "id string, name string, type string, config string")
    conns = spark.createDataFrame(
        [(c, ["events"], ["out"], "scheduled", "0 * * * *", json.dumps(how)) for c, how in strategies.items()],
        "id string, source_id array<string>, loader_id array<string>, sync_type string, schedule string, config string")
    ev, b = _t(spark, sf_dir, "events"), F.lit(SYNC_BOUNDARY).cast("timestamp_ntz")
    for new in (ev.where(F.col("ts") < b), ev.where(F.col("ts") >= b)):
        new.write.mode("append").parquet(source)
        run_all(spark, sources, loaders, conns)
    held = [read_synced(spark, out, c).withColumn("connection_id", F.lit(c)) for c in strategies]
    held = [df if "run" in df.columns else df.withColumn("run", F.lit(None)) for df in held]
    return reduce(DataFrame.unionByName, [df.select("connection_id", F.col("run").cast("long").alias("run"), *ev.columns) for df in held])


def run_scheduled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on fetched pages: three scheduled connections by url prefix, one
    prefix inside another. Returns the loaded chunks' sizes, read back."""
    import json

    from ferry.plans.run import run_scheduled as run_all
    out = new_run_dir(spark, "run-pages")
    sources = spark.createDataFrame([(k, k, cfg.WEB_SCRAPER, json.dumps({"url": u})) for k, u in PAGE_PREFIXES.items()],
                                    "id string, name string, type string, config string")
    loaders = spark.createDataFrame([("out", LOADER_NAME, cfg.JSON_LOADER, json.dumps({"path": out}))],
                                    "id string, name string, type string, config string")
    conns = spark.createDataFrame([(k, [k], ["out"], "scheduled", "0 * * * *") for k in PAGE_PREFIXES],
                                  "id string, source_id array<string>, loader_id array<string>, sync_type string, schedule string")
    run_all(spark, sources, loaders, conns, DOC_CHUNK_BYTES, pages=tb.table(spark, sf_dir, "pages"))
    back = json_loader.read_back(spark, out).groupBy("connection_id", F.shiftright("seq", 32).alias("page_id"))
    return back.agg(F.sum(F.octet_length("stringified_data")).cast("long").alias("n_bytes"),
                    F.count(F.lit(1)).cast("long").alias("n_chunks"))


def run_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manual connection that copies the documents table file with
    the file extractor into the JSON loader; returns the run report."""
    from ferry.plans.run import run_connection, single_connection_registry
    out = new_run_dir(spark, "run-sync")
    sources, loaders, conns = single_connection_registry(
        spark, "c1", "file_extractor", {"url": f"{sf_dir.rstrip('/')}/documents.parquet"},
        "json_loader", {"path": out})
    return run_connection(spark, "c1", sources, loaders, conns)


def _document_files(spark, sf_dir, name):
    """The documents as files of JSON lines, written by Spark."""
    place = new_run_dir(spark, name)
    lines = _t(spark, sf_dir, "documents", spread_rows=True).select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    lines.write.option("maxRecordsPerFile", str(LINES_PER_FILE)).text(place)
    return place


def run_sync_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on text: files of JSON lines are copied by the file extractor in
    chunks of 1,000 bytes, which cut lines and characters anywhere. The NDJSON
    read back, a file's chunks one after the other, holds the same lines."""
    from ferry.plans.run import run_connection, single_connection_registry
    out = new_run_dir(spark, "run-sync-text-out")
    registry = single_connection_registry(spark, "text", cfg.FILE_EXTRACTOR,
                                          {"url": _document_files(spark, sf_dir, "run-sync-text")},
                                          cfg.JSON_LOADER, {"path": out})
    run_connection(spark, "text", *registry, chunk_bytes=TEXT_CHUNK_BYTES)
    # at most LINES_PER_FILE lines in a cell
    files = json_loader.read_back(spark, out).groupBy("metadata.source").agg(
        F.array_sort(F.collect_list(F.struct("seq", "stringified_data"))).alias("_c"))
    text = F.array_join(F.transform("_c", lambda c: c["stringified_data"]), "")
    lines = files.select(F.explode(F.split(text, "\n")).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", "doc_id bigint, text string").alias("d")).select("d.*")


def _lines_before(table):
    """The files with the smallest id plus the lines of the files before each."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    table = table.sort_by("_begins")  # null last
    n = table.column("_n").to_numpy()
    first = pc.add(pa.array(np.cumsum(n) - n), pc.min(table.column("_begins")))
    return pa.table({"path": table.column("path"), "_first": first})


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 by lines: files of JSON lines in the order of doc_id, as many as their
    bytes ask for, read in byte ranges far shorter than a file. A line's number
    in its file, and the lines of the files before, give its number among all;
    numbers begin with the first document's id."""
    from ferry.sources.file_lines import read_lines
    place = new_run_dir(spark, "file-lines")
    docs = _t(spark, sf_dir, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_last()
    docs = docs.repartitionByRange(max(LINE_FILES, -(-size // LINE_FILE_BYTES)), order).sortWithinPartitions(order)
    docs.select(F.to_json(F.struct("doc_id", "text")).alias("value")).write.text(place)
    lines = read_lines(spark, place, LINE_RANGE_BYTES)
    doc = F.from_json(F.decode("data", "UTF-8"), "doc_id bigint, text string")
    rows = lines.select("path", "seq", doc.alias("d"))
    files = rows.groupBy("path").agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("seq") == 0, F.col("d.doc_id"))).alias("_begins"))
    # a group is the files' counts, a row for each LINE_FILE_BYTES
    first = files.withColumn("_all", F.lit(True)).groupBy("_all").applyInArrow(_lines_before, "path string, _first bigint")
    first = broadcast_if_small(first, materialize_first=True, name="file-begins")
    return rows.join(first, "path").select((F.col("_first") + F.col("seq")).alias("line"), "d.doc_id", "d.text")


def run_sync_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + K2 on files: a connection with a ledger of its files runs twice,
    the second time after new files have come; each run loads new ones only."""
    from ferry.plans.files import read_files
    from ferry.plans.run import run_connection, single_connection_registry
    place, out = new_run_dir(spark, "run-files"), new_run_dir(spark, "run-files-out")
    registry = single_connection_registry(spark, "files", cfg.FILE_EXTRACTOR, {"url": place}, cfg.JSON_LOADER, {"path": out},
                                          config={"mode": "append", "cursor": "bytes"})
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    for odd in (0, 1):
        lines = docs.where(F.col("doc_id") % 2 == odd).select(F.to_json(F.struct("doc_id", "text")).alias("value"))
        lines.write.mode("append").option("maxRecordsPerFile", str(LINES_PER_FILE)).text(place)
        run_connection(spark, "files", *registry, chunk_bytes=TEXT_CHUNK_BYTES)
    # at most LINES_PER_FILE lines in a cell
    files = read_files(spark, out, "files").groupBy("run", "metadata.source").agg(
        F.array_sort(F.collect_list(F.struct("seq", "stringified_data"))).alias("_c"))
    text = F.array_join(F.transform("_c", lambda c: c["stringified_data"]), "")
    lines = files.select("run", F.explode(F.split(text, "\n")).alias("line")).where("line <> ''")
    return lines.select("run", F.from_json("line", "doc_id bigint, text string").alias("d")).select("run", "d.*")


def run_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheduled connection per table file of the scale directory,
    plus a second connection on the documents file; every file is read
    once, and each connection gets its own copy of the chunks."""
    import json

    from ferry.plans.run import run_scheduled as run_all
    out = new_run_dir(spark, "run-scheduled")
    base = sf_dir.rstrip("/")
    sources = spark.createDataFrame(
        [(t, t, cfg.FILE_EXTRACTOR, json.dumps({"url": f"{base}/{t}.parquet"})) for t in tb.TABLES],
        "id string, name string, type string, config string")
    loaders = spark.createDataFrame([("out", LOADER_NAME, cfg.JSON_LOADER, json.dumps({"path": out}))],
                                    "id string, name string, type string, config string")
    conns = spark.createDataFrame(
        [(f"copy-{t}", [t], ["out"], "scheduled", "0 * * * *") for t in tb.TABLES]
        + [("copy-documents-2", ["documents"], ["out"], "scheduled", "30 * * * *")],
        "id string, source_id array<string>, loader_id array<string>, sync_type string, schedule string")
    return run_all(spark, sources, loaders, conns, FILE_CHUNK_BYTES)


QUERIES = {
    "run_sync_append": run_sync_append,
    "run_sync_upsert": run_sync_upsert,
    "extract_chunks": extract_chunks,
    "envelope_json": envelope_json,
    "queue_roundtrip": queue_roundtrip,
    "stringify": stringify,
    "until_end": until_end,
    "queue_rejects": queue_rejects,
    "page_source": page_source,
    "config_parse": config_parse,
    "options_map": options_map,
    "connection_resolve": connection_resolve,
    "connection_rejects": connection_rejects,
    "connector_lookup": connector_lookup,
    "route_sync_type": route_sync_type,
    "incremental_append": incremental_append,
    "dedup_latest": dedup_latest,
    "incremental_dedup": incremental_dedup,
    "dedup_exact": dedup_exact,
    "sync_state": sync_state,
    "full_override": full_override,
    "sync_append_runs": sync_append_runs,
    "sync_upsert_runs": sync_upsert_runs,
    "json_load": json_load,
    "queue_text": queue_text,
    "run_sync_text": run_sync_text,
    "run_sync_files": run_sync_files,
    "file_lines": file_lines,
    "file_chunks": file_chunks,
    "map_chunks": map_chunks,
    "queue_consume": queue_consume,
    "queue_consume_one": queue_consume_one,
    "stream_sync": stream_sync,
    "stream_dedup": stream_dedup,
    "stream_reorder": stream_reorder,
    "stream_upsert": stream_upsert,
    "stream_dedup_all": stream_dedup_all,
    "stream_state": stream_state,
    "stream_until_end": stream_until_end,
    "run_sync": run_sync,
    "run_scheduled": run_scheduled,
    "run_scheduled_tables": run_scheduled_tables,
    "run_scheduled_pages": run_scheduled_pages,
}


def queries():
    def wrap(fn):
        def run(spark, sf_dir):
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}
