"""Byte chunking of payload columns (A2), reassembly, per-chunk functions.

Chunking is a generator over each row (``explode(sequence(...))``): no
shuffle, no state, and work is spread exactly like the input partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import envelope as env
from ferry.plans.sizing import broadcast_if_small, materialize

#: Columns of a chunk's neighbourhood.
BEFORE, LAST = "_before", "_last"
# Fixed value: the producer's block size, 1 MiB.
DEFAULT_CHUNK_BYTES = 1024 * 1024


def chunk_column(df: DataFrame, payload, chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                 keep: list[str] | tuple[str, ...] = (), seq_col: str = "seq",
                 data_col: str = "data", edges: bool = False) -> DataFrame:
    """Cut a text or binary column into ``chunk_bytes`` pieces.

    Text is cut on its UTF-8 bytes, so a character may be split across two
    chunks (as the reference does). An empty or null payload gives no chunk;
    the last chunk of a payload is short. Output: ``keep`` + seq + data, and
    with ``edges`` what the text of a chunk needs of its neighbours: the bytes
    before it (``_before``) and whether it ends the payload (``_last``).
    """
    if chunk_bytes <= 0:
        raise ValueError("chunk_bytes must be positive")
    pcol = F.col(payload) if isinstance(payload, str) else payload
    dtype = df.select(pcol).schema.fields[0].dataType
    b = F.encode(pcol, "UTF-8") if isinstance(dtype, T.StringType) else pcol.cast("binary")
    n = F.lit(chunk_bytes).cast("long")
    with_bytes = df.select(*[F.col(k) for k in keep], b.alias("_b")).where(F.octet_length("_b") > 0)
    seqs = F.sequence(F.lit(0).cast("long"), F.floor((F.octet_length("_b") - 1) / n).cast("long"))
    exploded = with_bytes.select(*keep, "_b", F.explode(seqs).alias(seq_col))
    at = F.col(seq_col) * n
    front = F.least(at, F.lit(env.EDGE_BYTES))
    return exploded.select(
        *keep,
        F.col(seq_col),
        F.substring(F.col("_b"), at + 1, n).alias(data_col),
        *([F.substring(F.col("_b"), at - front + 1, front).alias(BEFORE),
           (at + n >= F.octet_length("_b")).alias(LAST)] if edges else []),
    )


def with_edges(messages: DataFrame) -> DataFrame:
    """Messages that are chunks of payloads, with ``_before`` and ``_last``
    (see ``chunk_column``), for messages that come without them, as from a
    queue. A payload is what one source sent in one queue of a connection; its
    chunks follow each other by ``seq``.

    A chunk that ends inside a character, or is shorter than one, hands its
    last bytes to the next three ``seq`` by an equi-join; a receiver takes
    those that reach up to it. Only keys and last bytes are written and joined,
    never a payload in one cell; where no chunk ends inside a character (ASCII,
    whole texts) nothing is joined at all. A chunk sent twice counts once.
    """
    keys = ["connection_id", "queue", "_source"]
    named = messages.withColumn("_source", F.col("metadata.source"))
    ends = materialize(named.select(*keys, "seq", env.last_bytes("data").alias("_end"),
                                    F.octet_length("data").alias("_n")), "chunk-ends")
    cut = ends.where((env.open_bytes("_end") > 0) | (F.col("_n") < env.EDGE_BYTES))
    if cut.isEmpty():
        return named.withColumn(BEFORE, F.lit(None).cast("binary")).withColumn(LAST, F.lit(True)).drop("_source")
    k = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    near = range(1, env.EDGE_BYTES + 1)
    handed = cut.select(*k, "seq", F.hex("_end").alias("_h"), F.explode(F.array(*map(F.lit, near))).alias("_d"))
    given = handed.groupBy(*[f"_k{i}" for i in range(3)], (F.col("seq") + F.col("_d")).alias("_seq")).agg(
        *[F.max(F.when(F.col("_d") == d, F.col("_h"))).alias(f"_h{d}") for d in near])
    # the chunk before, and where that is shorter than a character the ones before it
    front = F.lit("")
    for d in reversed(near):
        own = F.coalesce(f"_h{d}", F.lit(""))
        front = F.when(F.col(f"_h{d}").isNull(), F.lit("")).when(F.length(own) < 2 * env.EDGE_BYTES, F.concat(front, own)).otherwise(own)
    given = given.select(*[f"_k{i}" for i in range(3)], "_seq", F.unhex(front).alias(BEFORE))
    # a chunk whose next one never came keeps its open bytes
    follows = cut.select(*k, (F.col("seq") + 1).alias("_seq"))

    def same(left, right):
        on = [left[c].eqNullSafe(right[f"_k{i}"]) for i, c in enumerate(keys)]
        return reduce(and_, [*on, left["seq"] == right["_seq"]])

    side = broadcast_if_small(follows, name="chunk-follows")
    went_on = ends.join(side, same(ends, side), "left_semi").select(*k, (F.col("seq") - 1).alias("_seq"))
    both = given.unionByName(went_on.withColumn(BEFORE, F.lit(None).cast("binary")).withColumn("_next", F.lit(True)),
                             allowMissingColumns=True)
    both = both.groupBy(*[f"_k{i}" for i in range(3)], "_seq").agg(
        F.max(BEFORE).alias(BEFORE), F.coalesce(F.max("_next"), F.lit(False)).alias("_next"))
    side = broadcast_if_small(both, materialize_first=True, name="chunk-edges")
    joined = named.join(side, same(named, side), "left")
    return (joined.withColumn(LAST, ~F.coalesce(F.col("_next"), F.lit(False)))
            .drop("_source", "_next", "_seq", *[f"_k{i}" for i in range(3)]))


def reassemble(chunks: DataFrame, keys: list[str], seq_col: str = "seq",
               data_col: str = "data", out_col: str = "data") -> DataFrame:
    """Join the chunks of each key back into one payload, in ``seq`` order.

    One group is one original payload, so its size is bounded by the source
    row it was cut from (not by the table). Bytes are joined through hex to
    keep the concatenation linear in the payload size. ``complete`` is false
    when a chunk is missing (e.g. it was quarantined on the way).
    """
    # a chunk delivered twice counts once
    parts = F.array_sort(F.collect_set(F.struct(F.col(seq_col).alias("s"),
                                                F.hex(F.col(data_col)).alias("h"))))
    agg = chunks.groupBy(*keys).agg(
        F.unhex(F.array_join(F.transform(parts, lambda x: x["h"]), "")).alias(out_col),
        F.size(parts).cast("long").alias("n_chunks"),
        F.min(seq_col).alias("_first"),
        F.max(seq_col).alias("_last"),
        F.size(F.collect_set(seq_col)).cast("long").alias("_seqs"),
    )
    # complete = chunks 0..n-1 all present, each with one content
    whole = (F.col("_first") == 0) & (F.col("_last") + 1 == F.col("n_chunks")) & (F.col("_seqs") == F.col("n_chunks"))
    return agg.withColumn("complete", whole).drop("_first", "_last", "_seqs")


def map_chunks(chunks: DataFrame, fn: Callable[[bytes], object], result_type: T.DataType,
               keys: list[str], data_col: str = "data", result_col: str = "result",
               error_col: str = "error") -> DataFrame:
    """Apply a per-chunk function in Arrow batches (``mapInArrow``).

    A chunk whose function raises is not lost: it gets a null result and the
    exception text in ``error`` (the quarantine of B6). Split with
    ``accepted`` / ``quarantined``. Output: keys + result + error.
    """
    in_df = chunks.select(*keys, data_col)
    key_fields = [in_df.schema[k] for k in keys]
    out_schema = T.StructType(key_fields + [T.StructField(result_col, result_type),
                                            T.StructField(error_col, T.StringType())])
    arrow_out = _arrow_schema(out_schema)

    def run(batches):
        for batch in batches:
            datas = batch.column(data_col).to_pylist()
            results, errors = [], []
            for d in datas:
                try:
                    results.append(fn(d))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - quarantined, not raised
                    results.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            cols = [batch.column(k) for k in keys]
            cols.append(pa.array(results, type=arrow_out.field(result_col).type))
            cols.append(pa.array(errors, type=pa.string()))
            yield pa.RecordBatch.from_arrays(cols, schema=arrow_out)

    return in_df.mapInArrow(run, out_schema)


def accepted(df: DataFrame, error_col: str = "error") -> DataFrame:
    return df.where(F.col(error_col).isNull()).drop(error_col)


def quarantined(df: DataFrame, error_col: str = "error") -> DataFrame:
    return df.where(F.col(error_col).isNotNull())


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
