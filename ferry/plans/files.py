"""File connections synced incrementally (K2 for files).

A ledger holds, for each file of a connection, the bytes and chunks loaded so
far. A run lists the files, compares them with the ledger, and reads whole new
files and the bytes appended to known ones, nothing else. Its rows go to the
run's own directory; the new ledger is written last, so a run that died half
way is run again and replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.functions import envelope as env
from ferry.operators.chunks import BEFORE
from ferry.plans.sizing import materialize
from ferry.sinks import json_loader, snapshot
from ferry.sources.file_chunks import DEFAULT_PARTITION_BYTES, list_urls, read_listed

LEDGER_SCHEMA = "path string, size bigint, chunks bigint, run bigint"
TRUNCATED = "file was truncated"
CURSOR = "bytes"


def _places(root: str, connection_id: str) -> tuple[str, str]:
    own = f"connection_id={snapshot.escaped(connection_id)}"
    return f"{root.rstrip('/')}/files/{own}", f"{root.rstrip('/')}/ledger/{own}"


def read_ledger(spark: SparkSession, root: str, connection_id: str) -> DataFrame:
    place = snapshot.current_version(spark, _places(root, connection_id)[1])
    return spark.createDataFrame([], LEDGER_SCHEMA) if place is None else spark.read.schema(LEDGER_SCHEMA).parquet(place)


def _last_run(spark: SparkSession, root: str, connection_id: str) -> int:
    return max(snapshot.list_versions(spark, _places(root, connection_id)[1]), default=0)


def read_files(spark: SparkSession, root: str, connection_id: str) -> DataFrame:
    """The rows of the committed runs, with their ``run``."""
    place = _places(root, connection_id)[0]
    runs = _last_run(spark, root, connection_id)
    rows = spark.read.schema(f"{_schema_text()}, run bigint").options(
        **{k: v for k, v in env.JSON_WRITE_OPTIONS.items() if k != "ignoreNullFields"}).json(place)
    return rows.where(F.col("run") <= runs)


def _schema_text() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in json_loader.LOADED_SCHEMA.fields)


def sync_files(spark: SparkSession, url: str, connection_id: str, root: str, loader_name: str,
               chunk_bytes: int) -> tuple[DataFrame, int, int]:
    """One run; returns ``(files, chunks read, files rejected)``. ``files``:
    ``(path, size, start, reason)`` of the files that are new or have grown,
    and of those shorter than the ledger says, which are rejected and stay as
    they are in the ledger. A file that is gone stays in the ledger too.

    A file's new bytes are chunks of their own, numbered on. A character that
    the end of the file divides waits for the run that brings the rest of it.
    """
    run = _last_run(spark, root, connection_id) + 1
    rows, ledger_path = _places(root, connection_id)
    listing = materialize(list_urls(spark.createDataFrame([(url,)], "url string"), chunk_bytes), "listing")
    failed = listing.where(F.col("error").isNotNull()).select("error").first()
    if failed is not None:
        raise FileNotFoundError(f"{url}: {failed['error']}")
    ledger = read_ledger(spark, root, connection_id)
    known = ledger.select("path", F.col("size").alias("_had"), F.col("chunks").alias("_chunks"))
    found = listing.select("path", "size").join(known, "path", "left")
    start, base = F.coalesce("_had", F.lit(0)), F.coalesce("_chunks", F.lit(0))
    files = materialize(found.where(start != F.col("size")).select(
        "path", "size", start.alias("start"), base.alias("base"),
        F.when(start > F.col("size"), F.lit(TRUNCATED)).alias("reason")), "files-to-read")
    fresh = files.where(F.col("reason").isNull())
    chunks = read_listed(fresh.select("path", "size", "start", "base"), chunk_bytes, DEFAULT_PARTITION_BYTES, edges=True)
    msgs = env.build_messages(chunks, data=F.col("data"), source=F.col("path"), destination=loader_name,
                              connection_id=connection_id, queue=cfg.queue_name(F.lit(cfg.FILE_EXTRACTOR), F.lit(connection_id)),
                              seq=F.col("seq"), keep=[BEFORE])
    text = env.stringify_between("data", BEFORE, F.lit(False))
    loaded = msgs.select("connection_id", "queue", "seq", env.drop_payload(), "metadata", "created_at", "updated_at",
                         text.alias("stringified_data"), "IsEnd")
    (loaded.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**env.JSON_WRITE_OPTIONS)
     .json(f"{rows}/run={run}"))
    n_chunks = F.expr(f"(size - start + {chunk_bytes} - 1) div {chunk_bytes}")
    read = fresh.select("path", "size", (F.col("base") + n_chunks).alias("chunks"), F.lit(run).cast("long").alias("run"))
    after = ledger.join(read.select("path"), "path", "left_anti").unionByName(read)
    snapshot.write_version(after, ledger_path, version=run)
    n = fresh.agg(F.coalesce(F.sum(n_chunks), F.lit(0)).cast("long")).first()[0]
    return files.drop("base"), n, files.where(F.col("reason").isNotNull()).count()
