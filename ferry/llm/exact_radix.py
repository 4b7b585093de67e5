"""Exact dedup by distributed MSD radix partitioning (operator 4).

A text is read as its length followed by its UTF-8 bytes. Each round splits
every open group by its next digit, a slice of successive bytes whose width
grows by a fixed factor, so a text of n bytes needs O(log n) rounds. A group
closes when it holds one row or when its bytes have ended; equality is that
of the bytes, no digest takes part. Digits are counted with map-side partial
aggregation, so a group of copies that holds a third of all rows travels as
one row a task; the rows join the groups back on (group, digit), a join whose
hot keys adaptive execution splits. Only rows of groups that stay open are
written for the next round.

Rows: null text counts as empty, and all empty texts are one group; of equal
texts the row with the largest id stays (a null id loses to any other; of
rows that repeat an id, one stays); repeated rows are copies of each other;
an empty table gives an empty result. The row's own columns are carried in
one struct, so their names never clash with the working columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.plans.sizing import materialize

FIRST_DIGIT_BYTES = 64
DIGIT_GROWTH = 8
#: Open groups of at most this size are broadcast, larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep_columns: bool = False) -> DataFrame:
    """One row per input row: ``(id, keep_id, group_size, kept, text_sha256)``,
    and ``row`` (a struct of all input columns) with ``keep_columns``."""
    body = F.encode(F.coalesce(docs[text_col], F.lit("")), "UTF-8")
    row = F.struct(*[docs[c] for c in docs.columns]) if keep_columns else F.lit(None).cast("boolean")
    base = docs.select(docs[id_col].alias("id"), body.alias("rest"), F.sha2(body, 256).alias("sha"),
                       F.octet_length(body).cast("long").alias("group"), row.alias("row"),
                       F.monotonically_increasing_id().alias("rid"))
    width = FIRST_DIGIT_BYTES
    closed: list[DataFrame] = []
    final = ["id", "row", "rid", "sha", "group_size", "keep"]
    while True:
        cut = base.withColumn("digit", F.substring("rest", 1, width))
        groups = (cut.groupBy("group", "digit")
                  .agg(F.count(F.lit(1)).alias("group_size"),
                       F.max(F.struct(F.coalesce(F.col("id").isNotNull(), F.lit(False)).alias("has"),
                                      "id", "rid")).alias("keep"),
                       F.max(F.octet_length("rest") > width).alias("more"))
                  .withColumn("open", F.col("more") & (F.col("group_size") > 1)))
        # The ids of the groups are drawn once, so they are written before use.
        named = materialize(groups.withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        closed.append(cut.join(named.filter(~F.col("open")), ["group", "digit"]).select(*final))
        still = named.filter("open").select("group", "digit", "next")
        n_open = still.count()
        if n_open == 0:
            break
        # A row here is at most a digit and two numbers, which bounds its size.
        if n_open * (width + 64) <= BROADCAST_BYTES:
            still = F.broadcast(still)
        dealt = cut.join(still, ["group", "digit"])
        # More bytes to come: cut them off here, go on from shared storage.
        base = materialize(dealt.select(
            "id", "row", "rid", "sha", F.col("next").alias("group"),
            F.expr(f"substring(rest, {width + 1}, 2147483647)").alias("rest")), "radix-open")
        width *= DIGIT_GROWTH
    out = reduce(DataFrame.unionByName, closed)
    kept = (F.col("group_size") == 1) | (F.col("keep.rid") == F.col("rid"))
    return out.select(F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
                      kept.alias("kept"), F.col("sha").alias("text_sha256"),
                      *(["row"] if keep_columns else []))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    groups = exact_groups(docs, id_col, text_col, keep_columns=True)
    return groups.filter("kept").select("row.*")
