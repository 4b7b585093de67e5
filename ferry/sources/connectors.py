"""Pluggable connectors (I2): connector type -> how to read or write.

A source connector turns a parsed config into a DataFrame of byte chunks
``(seq, data)``, with ``path`` where the source is a file, and ``_before`` and
``_last`` where it knows a chunk's neighbours (else a join finds them); a loader connector
writes message rows. New connectors register with ``register_source`` /
``register_loader``: the type is then known to the config check (C8, C9), to
the type lookup (D3) and to runs (J1). A table connector (``register_table``)
gives rows instead of chunks, and where a table loader writes; connections
between two of them are synced by the strategy in the connection's config.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.operators import registry as reg
from ferry.operators.chunks import BEFORE, DEFAULT_CHUNK_BYTES, LAST, chunk_column
from ferry.sinks import json_loader
from ferry.sources.file_chunks import read_file_chunks
from ferry.sources.file_lines import read_lines
from ferry.sources.pages import read_pages

SourceFn = Callable[..., DataFrame]
LoaderFn = Callable[..., str]

_SOURCES: dict[str, SourceFn] = {}
_LOADERS: dict[str, LoaderFn] = {}
_TABLES: dict[str, SourceFn] = {}
_TABLE_LOADERS: set[str] = set()


def register_source(type_name: str, fn: SourceFn, field: str = "url", connector: str | None = None) -> None:
    """``field``: the config field that a source of this type requires."""
    cfg.CONFIG_FIELDS.setdefault(type_name, field)
    reg.CONNECTORS.setdefault(type_name, ("source", connector or type_name))
    _SOURCES[type_name] = fn


def register_loader(type_name: str, fn: LoaderFn, field: str = "path", connector: str | None = None) -> None:
    """``field``: the config field that a loader of this type requires."""
    cfg.CONFIG_FIELDS.setdefault(type_name, field)
    reg.CONNECTORS.setdefault(type_name, ("loader", connector or type_name))
    _LOADERS[type_name] = fn


def register_table(type_name: str, fn: SourceFn, field: str = "url", connector: str | None = None) -> None:
    """A source of rows: ``fn(spark, config, **options)`` gives a DataFrame."""
    cfg.CONFIG_FIELDS.setdefault(type_name, field)
    reg.CONNECTORS.setdefault(type_name, ("source", connector or type_name))
    _TABLES[type_name] = fn


def register_table_loader(type_name: str, connector: str | None = None) -> None:
    """A loader that keeps tables below its ``path``."""
    cfg.CONFIG_FIELDS.setdefault(type_name, "path")
    reg.CONNECTORS.setdefault(type_name, ("loader", connector or type_name))
    _TABLE_LOADERS.add(type_name)


def table_types() -> tuple[list[str], list[str]]:
    """The types that give rows, and those that keep tables."""
    return sorted(_TABLES), sorted(_TABLE_LOADERS)


def table_for(type_name: str) -> SourceFn:
    if type_name not in _TABLES:
        raise ValueError(f"{type_name} is not a source of rows")
    return _TABLES[type_name]


def check_table_loader(type_name: str) -> None:
    if type_name not in _TABLE_LOADERS:
        raise ValueError(f"{type_name} does not keep tables")


def source_for(type_name: str) -> SourceFn:
    if type_name not in _SOURCES:
        raise ValueError(f"{cfg.UNKNOWN_TYPE_PREFIX}{type_name}")
    return _SOURCES[type_name]


def loader_for(type_name: str) -> LoaderFn:
    if type_name not in _LOADERS:
        raise ValueError(f"{cfg.UNKNOWN_TYPE_PREFIX}{type_name}")
    return _LOADERS[type_name]


def _file_source(spark: SparkSession, config: dict, chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                 lines: bool = False, **_) -> DataFrame:
    """Byte chunks of the file (of a directory: numbered through its files in
    path order), or with ``lines=True`` one row per line (numbered file major,
    line minor); ``path`` is the file."""
    if lines:  # a line is a payload of its own
        rows = read_lines(spark, config["url"])
        return rows.select("path", (F.col("file_no") * F.lit(1 << 40) + F.col("seq")).alias("seq"), "data",
                           F.lit(None).cast("binary").alias(BEFORE), F.lit(True).alias(LAST))
    return read_file_chunks(spark, config["url"], chunk_bytes, continuous=True, edges=True)


def _page_source(spark: SparkSession, config: dict, chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                 pages=None, **_) -> DataFrame:
    """Pages whose url starts with the configured url, cut into chunks and
    numbered in page order (page_id major, chunk minor)."""
    if pages is None:
        raise ValueError("web_scraper needs a table of fetched pages (pages=...)")
    p = read_pages(spark, pages, url_prefix=config["url"])
    chunks = chunk_column(p, "data", chunk_bytes, keep=["page_id"], seq_col="_s", edges=True)
    return chunks.select((F.col("page_id") * F.lit(1 << 32) + F.col("_s")).alias("seq"), "data", BEFORE, LAST)


def _table_source(spark: SparkSession, config: dict, where: str | None = None, **_) -> DataFrame:
    """The rows of a parquet table, with ``where`` (SQL) those it selects."""
    df = spark.read.parquet(config["url"])
    return df if where is None else df.where(where)


def _json_loader(messages: DataFrame, config: dict, observation=None) -> str:
    """Replaces what an earlier run of the same connection wrote (K1), so a
    repeated run leaves one copy."""
    return json_loader.replace(json_loader.prepare(messages, observation), config["path"])


register_source(cfg.FILE_EXTRACTOR, _file_source)
register_source(cfg.WEB_SCRAPER, _page_source)
register_loader(cfg.JSON_LOADER, _json_loader)
register_table(cfg.TABLE_READER, _table_source, connector="parquet_table")
register_table_loader(cfg.TABLE_LOADER, connector="synced_table")
