"""Running connections.

``run_connection`` is the reference's whole workflow for one connection -
resolve, parse and validate configs, pick connectors, extract, envelope,
load - as one Spark plan per connection; its report row replaces the
reference's "started" reply with the actual outcome.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.functions import envelope as env
from ferry.operators import registry as reg
from ferry.operators.chunks import BEFORE, LAST, chunk_column
from ferry.plans import files, shared, sync
from ferry.plans.sizing import broadcast_if_small, materialize
from ferry.sinks import json_loader, snapshot
from ferry.sources import connectors
from ferry.sources.file_chunks import list_urls, read_listed
from ferry.sources.pages import join_prefixes, read_pages

REPORT_SCHEMA = "connection_id string, read bigint, loaded bigint, rejected bigint"


def single_connection_registry(spark: SparkSession, connection_id: str, source_type: str,
                               source_config: dict, loader_type: str, loader_config: dict,
                               sync_type: str = "manual", config: dict | None = None):
    """Registry tables holding one source, one loader and one connection."""
    sources = spark.createDataFrame(
        [("s-" + connection_id, "source", source_type, json.dumps(source_config))],
        "id string, name string, type string, config string")
    loaders = spark.createDataFrame(
        [("l-" + connection_id, "loader", loader_type, json.dumps(loader_config))],
        "id string, name string, type string, config string")
    conns = spark.createDataFrame(
        [(connection_id, ["s-" + connection_id], ["l-" + connection_id], sync_type, None,
          None if config is None else json.dumps(config))],
        "id string, source_id array<string>, loader_id array<string>, sync_type string, "
        "schedule string, config string")
    return sources, loaders, conns


def resolve_one(spark: SparkSession, connection_id: str, sources: DataFrame,
                loaders: DataFrame, conns: DataFrame) -> dict:
    """D4 + D2 + C8/C9 + E1 for one connection, by point lookups (filters on
    the id reach the scans); a bad reference, config or sync type raises
    ``ValueError`` (the reference exits the server process instead)."""
    conn = reg.find_by_id(conns, connection_id).select(
        cfg.first_id("source_id").alias("source_id"), cfg.first_id("loader_id").alias("loader_id"),
        "sync_type", (F.col("config") if "config" in conns.columns else F.lit(None).cast("string")).alias("config")
    ).first()
    if conn is None:
        raise ValueError(f"connection {connection_id} not found")
    out = {"connection_id": connection_id, "sync_type": conn["sync_type"],
           "strategy": read_strategy(conn["config"])}
    for side, table, ref, reason in (("source", sources, conn["source_id"], reg.INVALID_SOURCE),
                                     ("loader", loaders, conn["loader_id"], reg.INVALID_LOADER)):
        row = None if ref is None else reg.find_by_id(table, ref).select(
            "id", "name", "type", cfg.parse_config("type", "config").alias("cfg")).first()
        if row is None:
            raise ValueError(reason)
        if row["cfg"]["error"] is not None:
            raise ValueError(f"invalid {side} config: {row['cfg']['error']}")
        out.update({f"{side}_id": row["id"], f"{side}_name": row["name"], f"{side}_type": row["type"],
                    f"{side}_cfg": row["cfg"].asDict()})
    if conn["sync_type"] not in (reg.MANUAL, reg.SCHEDULED):
        raise ValueError("Invalid sync type")
    return out


def read_strategy(config: str | None) -> dict:
    """K1-K5: the sync strategy ``{"mode", "cursor", "keys", "order_by",
    "buckets"}`` in a connection's config; empty when none is given.
    ``order_by`` defaults to the cursor. Anything else raises ``ValueError``."""
    try:
        given = json.loads(config) if config and config.strip() else {}
    except json.JSONDecodeError:
        raise ValueError("invalid connection config: " + cfg.BAD_JSON_MESSAGE) from None
    if not isinstance(given, dict):
        raise ValueError("invalid connection config: " + cfg.BAD_JSON_MESSAGE)
    out = {k: given.get(k) for k in ("mode", "cursor", "keys", "order_by", "buckets")}
    if out["mode"] is None:
        return {}
    if out["order_by"] is None and out["cursor"]:
        out["order_by"] = [out["cursor"]]
    sync.check_strategy(out["mode"], out["cursor"], out["keys"], out["order_by"])
    return out


def synced_places(loader_config: dict, connection_id: str) -> tuple[str, str]:
    """Where a table loader keeps a connection's rows, and the sync states."""
    root = loader_config["path"].rstrip("/")
    return f"{root}/tables/connection_id={snapshot.escaped(connection_id)}", f"{root}/state"


def read_synced(spark: SparkSession, path: str, connection_id: str) -> DataFrame:
    """The rows that the committed runs of a synced connection left."""
    target, state_path = synced_places({"path": path}, connection_id)
    state = sync.connection_state(spark, state_path, connection_id)
    if state is None:
        raise FileNotFoundError(f"no committed run of {connection_id}")
    if state["mode"] == "append":
        return sync.read_appended(spark, target, state_path, connection_id)
    if state["buckets"]:
        return sync.read_upserted(spark, target, state_path, connection_id)
    return snapshot.read_current(spark, target)


def run_connection(spark: SparkSession, connection_id: str, sources: DataFrame,
                   loaders: DataFrame, conns: DataFrame, **source_options) -> DataFrame:
    """Extract -> envelope -> load for one connection; returns the
    report ``(connection_id, read, loaded, rejected)``. Between a table source
    and a table loader the strategy in the connection's config decides (full
    override when it names none); ``loaded`` is then one per key for upserts.
    Files with ``{"mode": "append", "cursor": "bytes"}`` are loaded
    incrementally (``plans.files``); ``rejected`` then counts files."""
    r = resolve_one(spark, connection_id, sources, loaders, conns)
    source_cfg = {k: v for k, v in r["source_cfg"].items() if k != "error" and v is not None}
    loader_cfg = {k: v for k, v in r["loader_cfg"].items() if k != "error" and v is not None}
    if (r["source_type"], r["loader_type"]) == (cfg.FILE_EXTRACTOR, cfg.JSON_LOADER) and r["strategy"]:
        n, bad = _sync_files(spark, connection_id, r["strategy"], source_cfg["url"], loader_cfg["path"], r["loader_name"],
                             source_options.get("chunk_bytes", connectors.DEFAULT_CHUNK_BYTES))
        return spark.createDataFrame([(connection_id, n, n, bad)], REPORT_SCHEMA)
    if r["strategy"] or r["loader_type"] == cfg.TABLE_LOADER:
        rows_fn = connectors.table_for(r["source_type"])
        connectors.check_table_loader(r["loader_type"])
        target, state_path = synced_places(loader_cfg, connection_id)
        done = sync.sync_table(spark, rows_fn(spark, source_cfg, **source_options), connection_id, target, state_path,
                               **(r["strategy"] or {"mode": "full"})).first()
        return spark.createDataFrame([(connection_id, done["rows_read"], done["rows_loaded"], 0)], REPORT_SCHEMA)
    read_fn = connectors.source_for(r["source_type"])
    write_fn = connectors.loader_for(r["loader_type"])

    counts = Observation(f"run-{connection_id}")
    chunks = read_fn(spark, source_cfg, **source_options)
    label = F.col("path") if "path" in chunks.columns else source_cfg.get("url", r["source_type"])
    messages = env.build_messages(
        chunks, data=F.col("data"), source=label, destination=r["loader_name"],
        connection_id=connection_id, queue=cfg.queue_name(F.lit(r["source_type"]), F.lit(connection_id)),
        seq=F.col("seq"), keep=[c for c in (BEFORE, LAST) if c in chunks.columns])
    write_fn(messages, loader_cfg, observation=counts)
    n_read, n_loaded = counts.get["read"], counts.get["loaded"]
    return spark.createDataFrame([(connection_id, n_read, n_loaded, n_read - n_loaded)], REPORT_SCHEMA)


def _sync_files(spark: SparkSession, connection_id: str, strategy: dict, url: str, path: str, loader_name: str,
                chunk_bytes: int) -> tuple[int, int]:
    """K2 on files: the chunks a run read, and the files it rejected."""
    if (strategy["mode"], strategy["cursor"]) != ("append", files.CURSOR):
        raise ValueError(f"files are synced by mode append with the cursor {files.CURSOR}")
    _, n, bad = files.sync_files(spark, url, connection_id, path, loader_name, chunk_bytes)
    return n, bad


def _run_ledger(spark: SparkSession, r, chunk_bytes: int) -> tuple[str, int | None, str | None]:
    """A scheduled file connection with a strategy: ``(id, chunks, reason)``."""
    try:
        n, bad = _sync_files(spark, r["connection_id"], read_strategy(r["config"]), r["_url"], r["_out"], r["loader_name"], chunk_bytes)
        return r["connection_id"], n, f"{bad} files: {files.TRUNCATED}" if bad else None
    except FileNotFoundError:
        return r["connection_id"], None, "source not found"
    except ValueError as e:
        return r["connection_id"], None, str(e)


def scheduled_connections(conns: DataFrame, sources: DataFrame, loaders: DataFrame) -> DataFrame:
    """J2 planning: every scheduled connection, resolved, with its queue,
    schedule, typed configs and ``reason`` (null = can run: both ids exist
    and both configs are valid)."""
    routed = reg.route_sync_type(conns).where(F.col("route") == reg.SCHEDULED)
    for optional in ("schedule", "config"):
        if optional not in routed.columns:
            routed = routed.withColumn(optional, F.lit(None).cast("string"))
    res = reg.resolve_connections(routed, sources, loaders, how="left", keep=("schedule", "config"))
    return res.withColumn("reason", F.coalesce(
        F.when(F.col("source_cfg").isNull(), F.lit(reg.INVALID_SOURCE)),
        F.when(F.col("loader_cfg").isNull(), F.lit(reg.INVALID_LOADER)),
        F.col("source_cfg.error"), F.col("loader_cfg.error")))


def run_scheduled(spark: SparkSession, sources: DataFrame, loaders: DataFrame, conns: DataFrame,
                  chunk_bytes: int = connectors.DEFAULT_CHUNK_BYTES,
                  pages: DataFrame | None = None) -> DataFrame:
    """Run every scheduled connection.

    File connections: the distinct urls (files, directories, patterns) are
    listed in tasks; each loader path is one write job that reads, once, the
    distinct files its connections need, and an equi-join on the file path
    hands each chunk to the connections reading it (every pair is an output
    row: each connection gets its own copy). Chunks of a directory are
    numbered through its files in path order. Page connections (with a table
    of fetched ``pages``): those whose url starts with the connection's. A run
    replaces what an earlier run of the same connection wrote. Table
    connections: each source table is scanned once for all its connections and
    their strategies (``plans.shared``). File connections with a strategy take
    what their ledger doesn't have (``plans.files``).

    Returns ``(connection_id, loaded, reason)`` for every scheduled
    connection, with the chunks or rows this run wrote; ``reason`` says why one
    did not run (bad reference or config, no such file, no pages table).
    """
    tables, table_loaders = connectors.table_types()
    is_table = F.col("source_type").isin(tables)
    keeps = F.col("loader_type").isin(table_loaders)
    strategy = F.get_json_object("config", "$.mode").isNotNull()
    ledger = strategy & (F.col("source_type") == cfg.FILE_EXTRACTOR) & (F.col("loader_type") == cfg.JSON_LOADER)
    unfit = (F.when(is_table & ~keeps, F.concat("loader_type", F.lit(" does not keep tables")))
             .when(~is_table & (keeps | (strategy & ~ledger)), F.concat("source_type", F.lit(" is not a source of rows")))
             .when(~is_table & ~F.col("source_type").isin(cfg.FILE_EXTRACTOR, cfg.WEB_SCRAPER), F.lit("no scheduled form of this type"))
             .when((F.col("source_type") == cfg.WEB_SCRAPER) & F.lit(pages is None), F.lit("no pages table")))
    own = {"ignoreNullFields": "true"}
    whole_plan = materialize(scheduled_connections(conns, sources, loaders).select(
        "connection_id", "source_type", F.col("source_cfg.url").alias("_url"),
        F.col("loader_cfg.path").alias("_out"), "loader_name", "queue", "config", is_table.alias("_table"),
        F.coalesce(ledger, F.lit(False)).alias("_ledger"),
        F.to_json(F.col("source_cfg").dropFields("error"), own).alias("source"),
        F.to_json(F.col("loader_cfg").dropFields("error"), own).alias("loader"),
        F.coalesce("reason", unfit).alias("reason")), "scheduled")
    of_tables = whole_plan.where(F.col("_table") & F.col("reason").isNull())
    table_runs = shared.run_sources(spark, of_tables, read_strategy, connectors.table_for, synced_places)
    of_files = whole_plan.where(F.col("_ledger") & F.col("reason").isNull())
    table_runs += [_run_ledger(spark, r, chunk_bytes) for r in of_files.toLocalIterator()]
    plan = whole_plan.where(~(F.coalesce("_table", F.lit(False)) | F.col("_ledger")) | F.col("reason").isNotNull())
    file_plan = plan.where(F.col("reason").isNull() & (F.col("source_type") == cfg.FILE_EXTRACTOR))
    listing = materialize(list_urls(file_plan.select(F.col("_url").alias("url")), chunk_bytes), "listing")
    failed = listing.where(F.col("error").isNotNull()).select(F.col("url").alias("_url"), "error")
    plan = materialize(plan.join(failed, "_url", "left")
                       .withColumn("reason", F.coalesce("reason", "error")).drop("error"), "runnable")
    runnable = plan.where(F.col("reason").isNull())
    found = listing.where(F.col("path").isNotNull()).drop("error")
    routes = materialize(runnable.where(F.col("source_type") == cfg.FILE_EXTRACTOR)
                         .join(found, F.col("_url") == F.col("url")).drop("url"), "routes")
    n_chunks = F.expr(f"(size + {chunk_bytes} - 1) div {chunk_bytes}")
    counts = routes.select("connection_id", n_chunks.alias("n"))
    web = None
    if pages is not None:
        p = read_pages(spark, pages)
        found_pages = join_prefixes(p, runnable.where(F.col("source_type") == cfg.WEB_SCRAPER))
        cut = chunk_column(found_pages, "data", chunk_bytes,
                           keep=["page_id", "connection_id", "_url", "_out", "loader_name", "queue"], seq_col="_s", edges=True)
        web = cut.select("connection_id", (F.col("page_id") * F.lit(1 << 32) + F.col("_s")).alias("seq"),
                         "data", BEFORE, LAST, F.col("_url").alias("_source"), "_out", "loader_name", "queue")
        counts = counts.unionByName(web.select("connection_id", F.lit(1).cast("long").alias("n")))
    counts = materialize(counts.groupBy("connection_id").agg(F.sum("n").cast("long").alias("loaded")), "counts")
    report = (plan.join(counts, "connection_id", "left")
              .select("connection_id", F.when(F.col("reason").isNull(), F.coalesce("loaded", F.lit(0)))
                      .cast("long").alias("loaded"), "reason", "_out"))
    for out in [r["_out"] for r in runnable.select("_out").distinct().collect()]:  # one job per loader path
        mine = routes.where(F.col("_out") == out)
        chunks = read_listed(mine.select("path", "size").distinct(), chunk_bytes, edges=True)
        to = broadcast_if_small(mine.select(F.col("path").alias("_source"), "first_seq", "connection_id",
                                            "loader_name", "queue"), name="routes-of-path")
        routed = chunks.join(to, chunks["path"] == F.col("_source")).select(
            "connection_id", (F.col("first_seq") + F.col("seq")).alias("seq"), "data", BEFORE, LAST, "_source",
            "loader_name", "queue")
        if web is not None:
            routed = routed.unionByName(web.where(F.col("_out") == out).drop("_out"))
        msgs = env.build_messages(routed, data=F.col("data"), source=F.col("_source"),
                                  destination=F.col("loader_name"), connection_id=F.col("connection_id"),
                                  queue=F.col("queue"), seq=F.col("seq"), keep=(BEFORE, LAST))
        idle = report.where((F.col("_out") == out) & (F.col("loaded") == 0)).select("connection_id")
        json_loader.replace(json_loader.prepare(msgs), out, (r[0] for r in idle.toLocalIterator()))
    ran = spark.createDataFrame(table_runs, "connection_id string, loaded bigint, reason string")
    return report.drop("_out").unionByName(ran)
