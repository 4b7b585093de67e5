"""Merkle manifest of a dataset by nested-struct rollup (operator 13).

A row's leaf is the digest of its fields, taken where the row is read; texts
are never shuffled. Per source the leaves get their rank from a range-
partitioned sort and one offset for each source of a partition. A rank is
cut into a block number and ``DIGITS`` digits to the base ``FAN``, one column
each. Rows meet once, by source and block; then the digit columns are grouped
away one after the other, lowest first, and every step nests the child
structs into their node, without another shuffle. A block is one row of at
most FAN ** DIGITS leaves, whatever the size of a source. Block roots are
ranked by their block number and rolled up the same way until each source has
one root, and the sources' roots likewise up to the root of the dataset.

Back down, a block's row meets its root's way up in a grouping by block;
transforms hand that way to all nodes of the nest, each adding its siblings,
and one explode emits the proofs. No leaf or node is joined to another.

Rows: a null field is the sign for null, a null source is a source of its own
and comes first, as null ids do in their source; rows that repeat an id order
by leaf; equal rows are leaves of their own; the tampering of a null id goes
by the checksum of the empty text; other columns are passed by; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.plans.sizing import broadcast_if_small, materialize

FAN = 3
#: Digits that are grouped away within a block: at most FAN ** DIGITS nodes in a row.
DIGITS = 6
#: Digests left and right of a node, from its lowest step up.
WAY = "array<struct<l:string,r:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) by ``order`` within ``group``, and the
    group's size ``n``. Rows are dealt by ranges of all of these and a row
    number, so neither a large group nor many equal rows meet in one task."""
    spark = rows.sparkSession
    keys = [F.asc_nulls_first(c) for c in (group, *order)]
    dealt = (rows.withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(*keys, F.asc("_row")).sortWithinPartitions(*keys, F.asc("_row")).drop("_row"))
    # the number of a partition above, that of the row in it below
    placed = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    part, pos = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    runs = (placed.groupBy(F.col(group).alias("_g"), part.alias("_part"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_first")))
    # at most one run for each partition and group, so few of a large group
    tops = runs.groupBy("_g").agg(F.sum("_n").alias("n"), F.array_sort(F.collect_list(F.struct("_part", "_n", "_first"))).alias("_runs"))
    before = F.aggregate(F.slice("_runs", 1, F.col("_i")), F.lit(0).cast("long"), lambda s, r: s + r["_n"])
    offsets = (tops.select("_g", "n", "_runs", F.posexplode("_runs").alias("_i", "_run"))
               .select("_g", "n", F.col("_run._part").alias("_part"), (before - F.col("_run._first")).alias("_off")))
    side = broadcast_if_small(offsets, name=f"{name}-offsets")
    placed = placed.withColumn("_p", part).withColumn("_pos", pos)
    return (placed.join(side, placed[group].eqNullSafe(side["_g"]) & (placed["_p"] == side["_part"]))
            .withColumn("rank", F.col("_pos") + F.col("_off")).drop("_at", "_p", "_pos", "_g", "_part", "_off"))


def roll_up(nodes: DataFrame, name: str) -> DataFrame:
    """``(grp, n, rank, node)`` -> ``(grp, n, block, tree)``: the digits of
    each block grouped away. ``node`` has ``h``; a node of the tree has ``h``
    and its children ``c`` in order. A group that is down to one node keeps
    it: its tree has one child there and the child's digest."""
    digit = [F.expr(f"rank div {FAN ** j} % {FAN}").cast("tinyint").alias(f"d{j}") for j in range(DIGITS)]
    rows = nodes.select("grp", "n", F.expr(f"rank div {FAN ** DIGITS}").alias("block"), *digit, "node").repartition("grp", "block")
    for j in range(DIGITS):
        keys = ["grp", "block", "n", *(f"d{i}" for i in range(DIGITS - 1, j, -1))]
        kids = F.transform(F.array_sort(F.collect_list(F.struct(f"d{j}", "node"))), lambda x: x["node"])
        rows = rows.groupBy(*keys).agg(kids.alias("c"))
        h = F.when(F.col("n") <= FAN ** j, F.col("c")[0]["h"]).otherwise(_joined(F.transform("c", lambda x: x["h"])))
        rows = rows.select(*keys, F.struct(h.alias("h"), "c").alias("node"))
    return materialize(rows.select("grp", "n", "block", F.col("node").alias("tree")), name)


def _children(alone: Column):
    """For a node and its way up: its children, each with its siblings put
    before that way; no step where the group was down to one node."""
    def children(e):
        c, way = e["x"]["c"], e["way"]

        def child(x, i):
            step = F.struct(F.array_join(F.transform(F.slice(c, 1, i), lambda y: y["h"]), "").alias("l"),
                            F.array_join(F.transform(F.slice(c, i + 2, FAN), lambda y: y["h"]), "").alias("r"))
            return F.struct(x.alias("x"), F.when(alone, way).otherwise(F.concat(F.array(step), way)).alias("way"))
        return F.transform(c, child)
    return children


def spread_ways(trees: DataFrame, ways: DataFrame) -> DataFrame:
    """The lowest nodes of all blocks with their ways up: ``(grp, x, way,
    subroot)``. ``ways``: ``(grp, block, way, subroot)`` of the blocks' roots."""
    tree = trees.schema["tree"].dataType.simpleString()
    t, w = f"struct<n:bigint,tree:{tree}>", f"struct<way:{WAY},subroot:string>"
    both = (trees.select("grp", "block", F.struct("n", "tree").alias("t"), F.lit(None).cast(w).alias("w"))
            .unionByName(ways.select("grp", "block", F.lit(None).cast(t).alias("t"), F.struct("way", "subroot").alias("w"))))
    met = both.groupBy("grp", "block").agg(F.first("t", True).alias("t"), F.first("w", True).alias("w"))
    out = met.select("grp", F.col("t.n").alias("n"), F.col("w.subroot").alias("subroot"),
                     F.array(F.struct(F.col("t.tree").alias("x"), F.col("w.way").alias("way"))).alias("a"))
    for j in reversed(range(DIGITS)):
        down = F.transform("a", _children(F.col("n") <= FAN ** j))
        out = out.select("grp", "n", "subroot", F.flatten(down).alias("a"))
    return out.select("grp", "subroot", F.explode("a").alias("e")).select("grp", "e.x", "e.way", "subroot")


def _to_one(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rolled-up tables, lowest first, until each group has one block."""
    tables = [roll_up(nodes, name)]
    while tables[-1].agg(F.max("block")).first()[0]:
        below = tables[-1].select("grp", F.expr(f"(n + {FAN ** DIGITS - 1}) div {FAN ** DIGITS}").alias("n"), F.col("block").alias("rank"),
                                  F.struct(F.col("tree.h").alias("h"), "block").alias("node"))
        tables.append(roll_up(below, name))
    return tables


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row: ``(doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified, source, proof)``. ``proof``: an array of steps
    from the leaf up, each with the digests left and right of it.
    ``tampered``: the texts that folded roots are made from (default: those
    with an even checksum of the id lose their line ends)."""
    if tampered is None:
        even = F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % 2 == 0
        tampered = F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    head = [field(docs[c]) for c in FIELDS[:-1]]
    leaves = docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("grp"),
                         digest(*head, field(docs["text"])).alias("h"),
                         F.when(~tampered.eqNullSafe(docs["text"]), digest(*head, field(tampered))).alias("changed"))
    leaves = materialize(leaves, "merkle-leaves")
    nodes = ranked(leaves, "grp", ["doc_id", "h"], "merkle-order")
    nodes = nodes.select("grp", "n", "rank", F.struct("h", "doc_id", "changed").alias("node"))
    tables = _to_one(nodes, "merkle-blocks")

    # A source's root, or its lone leaf, is the tree of its one block.
    tops = tables[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("source"), F.col("tree.h").alias("h"))
    tops = ranked(tops, "grp", ["source"], "merkle-sources")
    tops = tops.select("grp", "n", "rank", F.struct("h", "source").alias("node"))
    above = _to_one(tops, "merkle-source-blocks")
    top = above[-1].select("tree.h").first()  # one row
    root = top["h"] if top else None

    ways = above[-1].select("grp", "block", F.array().cast(WAY).alias("way"), F.lit(None).cast("string").alias("subroot"))
    for table in reversed(above[1:]):
        ways = spread_ways(table, ways).select("grp", F.col("x.block").alias("block"), "way", "subroot")
    ways = spread_ways(above[0], ways).select(F.col("x.source").alias("grp"), F.lit(0).cast("long").alias("block"), "way",
                                              F.col("x.h").alias("subroot"))
    for table in reversed(tables[1:]):
        ways = spread_ways(table, ways).select("grp", F.col("x.block").alias("block"), "way", "subroot")
    out = spread_ways(tables[0], materialize(ways, "merkle-ways"))
    way = F.col("way")
    folded = F.aggregate(way, F.coalesce("x.changed", "x.h"), lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]).cast("binary"), 256))
    siblings = _joined(F.transform(way, lambda s: F.concat(s["l"], s["r"])))
    return out.select(F.col("x.doc_id").alias("doc_id"), F.col("x.h").alias("leaf"), "subroot",
                      F.lit(root).cast("string").alias("root"), siblings.alias("proof_sha256"), folded.alias("folded_root"),
                      (folded == F.lit(root)).alias("verified"), F.col("grp").alias("source"), way.alias("proof"))
