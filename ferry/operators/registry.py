"""Sources, loaders and connections as tables.

The reference keeps these in a record store and checks them one request at
a time; here they are DataFrames validated and resolved with joins, so a
million connections cost one plan, not a million lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.plans.sizing import broadcast_if_small, materialize

# Route names, the reference's reject reasons.
MANUAL, SCHEDULED, INVALID = "manual", "scheduled", "invalid"
INVALID_SOURCE = "Invalid source_id"
INVALID_LOADER = "Invalid loader_id"
UNKNOWN_TYPE = "unknown type"
REQUIRED = {"sources": ["name", "type", "config"], "loaders": ["name", "type", "config"],
            "connections": ["source_id", "loader_id", "sync_type"]}

# Connector registry (I2): type -> (role, the connector that runs it). A
# handful of entries registered by code, so broadcasting it is bounded.
CONNECTORS = {
    cfg.FILE_EXTRACTOR: ("source", "file_chunks"),
    cfg.WEB_SCRAPER: ("source", "page_source"),
    cfg.JSON_LOADER: ("loader", "json"),
}


def connectors_df(spark) -> DataFrame:
    return spark.createDataFrame([(t, *v) for t, v in CONNECTORS.items()],
                                 "type string, role string, connector string")


def required_check(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``reason`` naming the first missing required field."""
    reason = F.lit(None).cast("string")
    for field in reversed(REQUIRED[kind]):
        c = F.col(field)
        dtype = df.schema[field].dataType.simpleString()
        empty = c.isNull() | (F.size(c) == 0 if dtype.startswith("array") else F.trim(c.cast("string")) == "")
        reason = F.when(empty, F.lit(f"{field} is required")).otherwise(reason)
    return df.withColumn("reason", reason)


def validate_registry(df: DataFrame, kind: str) -> DataFrame:
    """B5 check before append: required fields (E2), then the typed config
    (C8/C9). Output: the input + ``reason`` (null = may be stored)."""
    checked = required_check(df, kind)
    if kind in ("sources", "loaders"):
        parsed = cfg.parse_config("type", "config")
        checked = checked.withColumn("reason", F.coalesce(F.col("reason"), parsed["error"]))
    return checked


def append_registry(df: DataFrame, kind: str, path: str, sources: DataFrame | None = None,
                    loaders: DataFrame | None = None) -> DataFrame:
    """Append the valid rows to the registry table at ``path``; return
    the rejects (row + reason) instead of failing the whole batch.
    Connections need the ``sources`` and ``loaders`` tables: their ids (D2)
    and the sync type (E1) are checked before a row is stored."""
    checked = validate_registry(df, kind)
    if kind == "connections":
        if sources is None or loaders is None:
            raise ValueError("connections are checked against sources and loaders")
        refs = check_references(df, sources, loaders).select(
            F.col("connection_id").alias("_id"), F.col("reason").alias("_ref")).dropDuplicates(["_id"])
        known = F.coalesce(F.col("sync_type").isin(MANUAL, SCHEDULED), F.lit(False))
        bad_type = F.when(~known, F.lit("Invalid sync type"))
        checked = (checked.join(refs, checked["id"].eqNullSafe(refs["_id"]), "left")
                   .withColumn("reason", F.coalesce("reason", "_ref", bad_type)).drop("_id", "_ref"))
    checked = materialize(checked, "registry-checked")
    checked.where(F.col("reason").isNull()).drop("reason").write.mode("append").parquet(path)
    return checked.where(F.col("reason").isNotNull())


def route_sync_type(conns: DataFrame, col: str = "sync_type") -> DataFrame:
    """Route column ``manual`` / ``scheduled`` / ``invalid``."""
    c = F.col(col)
    return conns.withColumn("route", F.when(c == MANUAL, F.lit(MANUAL))
                            .when(c == SCHEDULED, F.lit(SCHEDULED))
                            .otherwise(F.lit(INVALID)))


def find_by_id(df: DataFrame, id_value: str, id_col: str = "id") -> DataFrame:
    """Point lookup (a pushed-down equality filter)."""
    return df.where(F.col(id_col) == F.lit(id_value))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    parsed = cfg.parse_config("type", "config")
    return df.select(
        F.col("id").alias(f"{prefix}_id"),
        F.col("name").alias(f"{prefix}_name"),
        F.col("type").alias(f"{prefix}_type"),
        parsed.alias(f"{prefix}_cfg"),
    )


def resolve_connections(conns: DataFrame, sources: DataFrame, loaders: DataFrame,
                        how: str = "inner", keep: tuple[str, ...] = ()) -> DataFrame:
    """D1 (+C14, C8, C7): each connection with its source and loader rows,
    typed configs, queue name, and the ``keep`` columns of the connection.
    Inner joins: unresolved ids drop out (see ``check_references`` for them);
    with ``how="left"`` they stay, with a null ``source_cfg`` or
    ``loader_cfg``. Registry sides are broadcast only when measured small."""
    c = conns.select(F.col("id").alias("connection_id"),
                     cfg.first_id("source_id").alias("source_id"),
                     cfg.first_id("loader_id").alias("loader_id"),
                     F.col("sync_type"), *keep)
    s = broadcast_if_small(_side(sources, "source"))
    l_ = broadcast_if_small(_side(loaders, "loader"))
    out = c.join(s, "source_id", how).join(l_, "loader_id", how)
    return out.withColumn("queue", cfg.queue_name("source_type", "connection_id"))


def check_references(conns: DataFrame, sources: DataFrame, loaders: DataFrame) -> DataFrame:
    """``reason`` per connection: the source is tested first, as the
    reference does; null reason = both ids exist. Left joins against the id
    sets (each id once), so the connection table is never duplicated."""
    c = conns.select(F.col("id").alias("connection_id"),
                     cfg.first_id("source_id").alias("source_id"),
                     cfg.first_id("loader_id").alias("loader_id"))
    sid = broadcast_if_small(sources.select(F.col("id").alias("source_id")).distinct()
                             .withColumn("_s", F.lit(True)))
    lid = broadcast_if_small(loaders.select(F.col("id").alias("loader_id")).distinct()
                             .withColumn("_l", F.lit(True)))
    j = c.join(sid, "source_id", "left").join(lid, "loader_id", "left")
    reason = (F.when(F.col("_s").isNull(), F.lit(INVALID_SOURCE))
              .when(F.col("_l").isNull(), F.lit(INVALID_LOADER)))
    return j.select("connection_id", "source_id", "loader_id", reason.alias("reason"))


def lookup_connector(df: DataFrame, type_col: str = "type") -> DataFrame:
    """D3: type -> connector via the fixed connector registry; an unknown
    type gets null connector and reason ``unknown type``."""
    reg = F.broadcast(connectors_df(df.sparkSession).select(
        F.col("type").alias("_t"), "connector"))
    j = df.join(reg, F.col(type_col).eqNullSafe(F.col("_t")), "left").drop("_t")
    return j.withColumn("reason", F.when(F.col("connector").isNull(), F.lit(UNKNOWN_TYPE)))
