"""JSON loader (B2): per connection, stop at the end marker, stringify the
payload, drop the bytes, write NDJSON partitioned by connection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import envelope as env
from ferry.operators.chunks import BEFORE, LAST, with_edges
from ferry.operators.queue import until_end
from ferry.sinks import snapshot

# Written columns, in order (``connection_id`` becomes the directory).
LOADED_SCHEMA = T.StructType(
    [f for f in env.MESSAGE_SCHEMA.fields if f.name != "connection_id"]
    + [T.StructField("connection_id", T.StringType())])


def prepare(messages: DataFrame, observation=None, chunked: bool = True) -> DataFrame:
    """G1 -> C5 -> C6: the rows the loader writes, payload as text.
    ``observation`` gets ``read`` / ``loaded`` counts (see ``until_end``).

    With ``chunked`` the messages of a queue are chunks of longer payloads and
    a character that a cut divides goes whole into the chunk it ends in: from
    the neighbours that the source sent along (``chunk_column`` or a file read
    with ``edges``), else by a join (``with_edges``). Without it every message
    is a payload of its own."""
    kept = until_end(messages, queue_col="queue", seq_col="seq", observation=observation)
    if chunked and BEFORE not in kept.columns:
        kept = with_edges(kept)
    text = env.stringify_between("data", BEFORE, LAST) if chunked else env.stringify("data")
    return kept.select(
        "connection_id", "queue", "seq",
        env.drop_payload(),
        "metadata", "created_at", "updated_at",
        text.alias("stringified_data"),
        F.col("IsEnd"),
    )


def write(loaded: DataFrame, path: str, mode: str = "append") -> str:
    (loaded.write.mode(mode).options(**env.JSON_WRITE_OPTIONS)
     .partitionBy("connection_id").json(path))
    return path


def replace(loaded: DataFrame, path: str, connections=()) -> str:
    """Write ``loaded`` in place of what its connections (and the named ones,
    which may have no row left) had below ``path``."""
    return snapshot.override_partitions(loaded, path, ["connection_id"], fmt="json",
                                        options=env.JSON_WRITE_OPTIONS, replaced=connections)


def load(messages: DataFrame, path: str, mode: str = "append", chunked: bool = True) -> str:
    return write(prepare(messages, chunked=chunked), path, mode)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(LOADED_SCHEMA)
            .options(**{k: v for k, v in env.JSON_WRITE_OPTIONS.items() if k != "ignoreNullFields"})
            .json(path))
