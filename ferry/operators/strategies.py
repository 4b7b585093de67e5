"""Sync strategies (K1-K6): full override, incremental append, dedup,
upsert, sync state.

Dedup is written as an aggregate (``max`` of an ordering struct) instead of
``row_number`` over a window: the aggregate combines map-side, so a key that
holds a third of the table costs one row per map task in the shuffle, while
a window would sort that whole key inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.plans.sizing import broadcast_if_small


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _order_struct(order_by: list[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cols)])


def dedup_latest(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """K3: one row per key: greatest ``order_by[0]`` (nulls last), ties broken
    by the following columns, all descending. Null keys form one group.

    When every column is orderable the whole row joins the ordering struct,
    so even full ties resolve the same way on every run.
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    order = _order_struct(order_by)
    if all(_orderable(f.dataType) for f in df.schema.fields):
        best = F.max(F.struct(order.alias("o"), row.alias("r")))["r"]
    else:
        best = F.max_by(row, order)
    agg = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best.alias("_best"))
    return agg.select(*[F.col("_best")[c].alias(c) for c in cols])


def dedup_exact(df: DataFrame, payload: str, id_col: str) -> DataFrame:
    """K4: one row per distinct payload, the smallest id kept.

    Rows are grouped by the SHA-256 of the payload (32 bytes) rather than
    the payload itself, so the shuffle key stays small; duplicates collapse
    map-side before the shuffle.
    """
    cols = df.columns
    p = F.col(payload)
    digest = F.sha2(p if isinstance(df.schema[payload].dataType, T.BinaryType) else F.encode(p, "UTF-8"), 256)
    others = [c for c in cols if c != id_col]
    row = F.struct(*[F.col(c) for c in others])
    if all(_orderable(df.schema[c].dataType) for c in others):
        best = F.min(F.struct(F.col(id_col).alias("_id"), row.alias("r")))
    else:  # e.g. a map column can't break ties
        best = F.struct(F.min(id_col).alias("_id"), F.min_by(row, F.col(id_col)).alias("r"))
    agg = df.groupBy(digest.alias("_h")).agg(best.alias("_b"))
    out = {id_col: F.col("_b._id")}
    return agg.select(*[(out[c] if c == id_col else F.col("_b.r")[c]).alias(c) for c in cols])


def incremental_append(df: DataFrame, cursor: str, state_cursor=None) -> DataFrame:
    """K2 for one connection: rows with ``cursor > state_cursor``; no state
    means a first sync, all rows (null cursors included). The cursor value
    is a literal, so the filter reaches the parquet / JDBC scan."""
    if state_cursor is None:
        return df
    return df.where(F.col(cursor) > F.lit(state_cursor))


def incremental_by_connection(df: DataFrame, state: DataFrame, cursor: str,
                              conn_col: str = "connection_id",
                              state_cursor_col: str = "cursor") -> DataFrame:
    """K2 for many connections: join the state (one row per connection,
    broadcast under a proven bound) and keep ``cursor > state.cursor``;
    connections without state take all rows. A connection whose stored cursor
    is null has been synced: its rows with a cursor are new, those without
    one went in its first sync."""
    st = broadcast_if_small(state.select(F.col(conn_col).alias("_conn"), F.col(state_cursor_col).alias("_state"),
                                         F.lit(True).alias("_synced")))
    j = df.join(st, df[conn_col] == st["_conn"], "left")
    newer = F.col(cursor).isNotNull() & (F.col("_state").isNull() | (F.col(cursor) > F.col("_state")))
    return j.where(F.col("_synced").isNull() | newer).select(*[df[c] for c in df.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str | Column],
           cursor: str | None = None, state_cursor=None) -> DataFrame:
    """K5: ``dedup_latest(target ∪ source rows with cursor >= state)``.

    ``>=`` so rows that tie on the boundary are not lost; rows read twice
    collapse in the dedup. No deletes. Write the result to a new location
    (``full_override``), never over the target being read.
    """
    delta = source
    if cursor is not None and state_cursor is not None:
        delta = source.where(F.col(cursor) >= F.lit(state_cursor))
    return dedup_latest(target.unionByName(delta), keys, order_by)


def sync_state(df: DataFrame, group_cols: list[str], cursor: str,
               prior: DataFrame | None = None) -> DataFrame:
    """K6: per group, ``cursor`` = max cursor and ``rows_read`` = count.

    With a prior state the new batch is folded in: the cursor never moves
    back (max over old and new), counts add up, and groups without new rows
    keep their old state. The fold is one aggregate over the union of the
    new rows and the prior state rows - no join, one shuffle.
    """
    new = df.select(*group_cols, F.col(cursor).alias("cursor"), F.lit(1).cast("long").alias("_n"))
    if prior is not None:
        new = new.unionByName(prior.select(*group_cols, F.col("cursor").cast(new.schema["cursor"].dataType),
                                           F.col("rows_read").cast("long").alias("_n")))
    return new.groupBy(*group_cols).agg(F.max("cursor").alias("cursor"),
                                        F.sum("_n").cast("long").alias("rows_read"))
