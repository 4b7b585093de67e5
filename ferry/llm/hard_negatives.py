"""Hard negatives by threshold joins over a pruned inverted index (operator 12).

Anchors are the stated query set; they meet all rows block by block, so a task
holds one block of rows and one of anchors. Dimensions are ordered by their
share of all squares, the largest first. In a block, a row's postings reach
only so far as a score from the threshold on is still possible: the dimensions
from there on, whose norm times that of the anchors' same dimensions stays
below the threshold, are omitted from the index. With the rows in order of
their reach, the postings of a segment of dimensions are those of a first part
of the rows. Partial scores add up segment by segment; an anchor and row
whose partial score plus the product of their remaining norms is below the
anchor's threshold go, and with them the rows that no anchor needs. What is
left gets the omitted dimensions added and so its exact score.

A threshold starts high and falls until the windows are full: first until an
anchor has its positives in the block, then, between the positives' scores and
their lower ends, until each positive has its negatives. An anchor whose
windows are full takes no part in the next round; the last round's threshold
lets everything through, so no score is missed. Each block gives its first few
rows of every window, and one ranking a window joins them.

Scores are exact integers: products are made in single or double precision
where their norms prove that every sum fits, else with Python's integers;
a score outside 64 bits counts as the nearest one that fits.

Rows: a null label or vector, or a null or non-finite component, takes no
part; a shorter vector counts as zero behind its end, and an empty one as
zero; rows that repeat an id are rows of their own (and anchors each); a null
id is no anchor and comes last among ties; ties go by the smaller id; an
anchor without other rows of its label, or a positive below zero, gives no
rows; other columns are passed by; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.textbatch import ragged
from ferry.plans.sizing import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Negatives score from LOW / 100 of their positive's score up to it.
LOW = 80
ROW_BLOCK, ANCHOR_BLOCK = 32_768, 2_048
#: Dimensions that are added up between two prunings.
SEGMENT = 8
#: Anchors whose partial scores a task holds at a time.
AT_ONCE = 64
#: First threshold as a share of the largest possible score, and how it falls from round to round.
START, FALL, ROUNDS = 0.6, 0.7, 5
LARGEST = (1 << 63) - 1


def relabelled(rows: DataFrame) -> DataFrame:
    """Where ``vec_id`` is divisible by 7, the next of ten labels."""
    moved = (F.col("label") + 1) % 10
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))


def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column) -> DataFrame:
    """``(id, label, v, anchor, rid)`` of the rows that take part; v: whole numbers as doubles."""
    v = rows[vector_col].cast("array<double>")
    sound = rows[label_col].isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() of Spark is a long; beyond 2^53 a double is whole already
    whole = F.transform(v, lambda x: F.when(F.abs(x) < 2.0 ** 44, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    return (rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].cast("string").alias("label"), v.alias("v"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor"), sound.alias("sound"), whole.alias("w"))
            .where(F.coalesce("sound", F.lit(False))).select("id", "label", F.col("w").alias("v"), "anchor")
            .withColumn("rid", F.monotonically_increasing_id()))


class Vectors:
    """Vectors of a list column with the dimensions in the given order."""

    def __init__(self, cells, rows: np.ndarray, order: np.ndarray):
        values, off = cells
        lens = np.diff(off)[rows]
        size = max(len(order), int(lens.max(initial=0)))
        x = np.zeros((len(rows), size))
        own = np.repeat(np.arange(len(rows)), lens)
        x[own, ragged(np.zeros(len(rows), np.int64), lens)] = values[ragged(off[:-1][rows], lens)]
        self.x = x[:, np.concatenate([order, np.setdiff1d(np.arange(size), order)])]

    def norms(self, cuts: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from each cut on, rounded up."""
        with np.errstate(over="ignore"):
            rest = np.cumsum((self.x * self.x)[:, ::-1], axis=1)[:, ::-1]
        rest = np.concatenate([rest, np.zeros((len(self.x), 1))], axis=1)
        return np.sqrt(rest[:, cuts]) * (1 + 1e-9)


def _exact(x: np.ndarray, q: np.ndarray):
    """The two sides in the narrowest numbers in which every sum is exact."""
    with np.errstate(over="ignore"):
        most = float(np.sqrt((x * x).sum(1).max(initial=0))) * float(np.sqrt((q * q).sum(1).max(initial=0)))
    if most < 2 ** 24:
        return x.astype(np.float32), q.astype(np.float32)
    if most < 2 ** 53:
        return x, q
    return tuple(np.array([int(v) for v in a.ravel().tolist()], object).reshape(a.shape) for a in (x, q))


class Block:
    """The inverted index of one block of rows for one group of anchors."""

    def __init__(self, rows: Vectors, anchors: Vectors):
        size = max(rows.x.shape[1], anchors.x.shape[1])
        for v in (rows, anchors):
            if v.x.shape[1] < size:
                v.x = np.pad(v.x, ((0, 0), (0, size - v.x.shape[1])))
        self.cuts = np.append(np.arange(0, size, SEGMENT), size)
        self.x, self.q = _exact(rows.x, anchors.x)
        self.x_rest, self.q_rest = rows.norms(self.cuts), anchors.norms(self.cuts)
        self.bounded = self.x_rest.max(initial=0) < 1e150 and self.q_rest.max(initial=0) < 1e150
        if not self.bounded:  # norms beyond doubles: nothing is omitted or pruned
            self.x_rest[:], self.q_rest[:] = np.inf, np.inf

    def bound(self) -> np.ndarray:
        """No score of an anchor lies above this (0: not known)."""
        return self.q_rest[:, 0] * self.x_rest[:, 0].max(initial=0) if self.bounded else np.zeros(len(self.q))

    def scores_from(self, which: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (anchor, row, score) with a score of at least ``least`` of the
        anchor, for the anchors ``which``."""
        q, q_rest = self.q[which], self.q_rest[which]
        steps = len(self.cuts) - 1
        # The reach of a row's postings: beyond it no anchor can come to the lowest threshold.
        can = self.x_rest * q_rest.max(axis=0, initial=0) >= least.min(initial=np.inf)
        reach = np.where(can, np.arange(1, steps + 2), 0).max(axis=1)
        reach = np.minimum(reach, steps)
        order = np.argsort(-reach, kind="stable")
        order = order[reach[order] > 0]
        reach = reach[order]
        score = np.zeros((len(which), len(order)), self.x.dtype)
        alive = None
        for s in range(steps):
            there = int(np.searchsorted(-reach, -s, "left"))  # rows whose postings hold this segment
            if not there:
                break
            lo, hi = self.cuts[s], self.cuts[s + 1]
            score[:, :there] += q[:, lo:hi] @ self.x[order[:there], lo:hi].T
            if s + 1 < steps and s % 2 == 0:
                continue
            # what isn't added yet: from the next segment on, or from the end of a row's postings
            now = score[:, :there] + q_rest[:, s + 1, None] * self.x_rest[order[:there], s + 1][None] >= least[:, None]
            if alive is None and there < len(order):
                after = reach[there:]
                alive = score[:, there:] + q_rest[:, after] * self.x_rest[order[there:], after][None] >= least[:, None]
                alive = np.concatenate([now, alive], axis=1)
            elif alive is None:
                alive = now
            else:
                alive[:, :there] = now
            needed = alive.any(axis=0)
            if needed.mean() < 0.7:
                order, reach, score, alive = order[needed], reach[needed], score[:, needed], alive[:, needed]
        if alive is None:
            if not len(order):
                return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
            alive = np.ones(score.shape, bool)
        a, r = np.nonzero(alive)
        exact = score[a, r]
        for s in np.unique(reach):  # add what the index omits
            short = np.flatnonzero(reach[r] == s)
            at = self.cuts[s]
            if at < self.cuts[-1] and len(short):
                exact[short] += (q[a[short], at:] * self.x[order[r[short]], at:]).sum(axis=1)
        if exact.dtype == object:
            exact = np.array([max(-LARGEST - 1, min(LARGEST, v)) for v in exact.tolist()], object)
        keep = (exact >= least[a]).astype(bool)
        return a[keep], order[r[keep]], exact[keep]


def _falling(scores: np.ndarray) -> np.ndarray:
    """Keys that sort as the scores do, the largest first."""
    return -np.unique(scores, return_inverse=True)[1] if scores.dtype == object else -scores


def _first(window: np.ndarray, score: np.ndarray, ids: np.ndarray, rid: np.ndarray, n: int) -> np.ndarray:
    """Of each window the first n by score, then id, then row."""
    order = np.lexsort((rid, ids, _falling(score), window))
    w = window[order]
    head = np.append(True, w[1:] != w[:-1])[:len(w)]
    start = np.maximum.accumulate(np.where(head, np.arange(len(w)), 0)) if len(w) else order
    return order[np.arange(len(w)) - start < n]


def _rounds(block: Block, first: np.ndarray, last: np.ndarray, take, full) -> None:
    """Lower the thresholds from ``first`` to ``last``: ``take`` gets all
    scores of the open anchors from their thresholds on, ``full`` says which
    of them need no more."""
    open_ = np.arange(len(first))
    level = first
    for turn in range(ROUNDS + 1):
        done = turn == ROUNDS
        least = last if done else np.maximum(level, last)
        for lo in range(0, len(open_), AT_ONCE):
            part = open_[lo:lo + AT_ONCE]
            a, r, s = block.scores_from(part, least[part])
            take(part, part[a], r, s, least)
        open_ = open_[~(full(open_, least) | (least[open_] <= last[open_]))]
        if not len(open_):
            return
        level = level - (1 - FALL) * np.abs(level) if turn < ROUNDS - 1 else last


def _sides(table: pa.Table):
    """Rows and anchors of a block, ids (a null one last), row numbers, labels as numbers, vectors."""
    table = table.combine_chunks()
    asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    ids = table.column("id").fill_null(LARGEST).to_numpy()
    label, _ = pd.factorize(np.array(table.column("label").to_pylist(), object))
    v = table.column("v").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.float64()))
    off = v.offsets.to_numpy().astype(np.int64)
    return (np.flatnonzero(~asks), np.flatnonzero(asks), ids, table.column("rid").to_numpy(), label,
            (v.values.to_numpy(zero_copy_only=False), off))


def _positives(order: np.ndarray):
    """The first positives of each anchor among the rows of a block."""
    def run(table: pa.Table) -> pa.Table:
        rows, asks, ids, rid, label, cells = _sides(table)
        out = []
        for name in np.unique(label[asks]):  # a label's rows and its anchors
            x, q = rows[label[rows] == name], asks[label[asks] == name]
            if not len(x):
                continue
            block = Block(Vectors(cells, x, order), Vectors(cells, q, order))
            found = {}

            def take(part, a, r, s, least):
                other = rid[x[r]] != rid[q[a]]
                a, r, s = a[other], r[other], s[other]
                best = _first(a, s, ids[x[r]], rid[x[r]], POSITIVES)
                for k in part.tolist():
                    found[k] = []
                for k, i, v in zip(a[best].tolist(), r[best].tolist(), s[best].tolist()):
                    found[k].append((i, int(v)))

            top = block.bound()
            _rounds(block, START * top, np.full(len(q), -np.inf), take,
                    lambda open_, least: np.array([len(found[k]) >= POSITIVES for k in open_.tolist()], bool))
            out += [(int(rid[q[k]]), int(ids[x[i]]), int(rid[x[i]]), v) for k, v_ in found.items() for i, v in v_]
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({"arid": pa.array(cols[0], pa.int64()), "pid": pa.array(cols[1], pa.int64()),
                         "prid": pa.array(cols[2], pa.int64()), "score": pa.array(cols[3], pa.int64())})
    return run


def _negatives(order: np.ndarray):
    """The first negatives of each window among the rows of a block."""
    def run(table: pa.Table) -> pa.Table:
        rows, asks, ids, rid, label, cells = _sides(table)
        out = []
        if len(rows) and len(asks):
            asked = table.column("windows").take(pa.array(asks)).to_pylist()
            tops = [sorted({int(p) for p in w}, reverse=True) for w in asked]
            low = [[-(-LOW * p // 100) for p in w] for w in tops]  # lowest whole score of a window
            block = Block(Vectors(cells, rows, order), Vectors(cells, asks, order))
            found: dict = {}

            def take(part, a, r, s, least):
                other = label[rows[r]] != label[asks[a]]
                a, r, s = a[other], r[other], s[other]
                for k in part.tolist():
                    found[k] = [[] for _ in tops[k]]
                best = np.lexsort((rid[rows[r]], ids[rows[r]], _falling(s), a))
                a, r, s = a[best], r[best], s[best]
                bounds = np.searchsorted(a, [*part, part[-1] + 1])
                for k, lo, hi in zip(part.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = -s[lo:hi]
                    for w, (p, least_of) in enumerate(zip(tops[k], low[k])):
                        at = lo + int(np.searchsorted(own, -p))
                        end = min(at + NEGATIVES, lo + int(np.searchsorted(own, -least_of, "right")))
                        found[k][w] = [(int(r[i]), int(s[i])) for i in range(at, end)]

            def full(open_, least):
                return np.array([all(len(f) >= NEGATIVES or least[k] <= lo for f, lo in zip(found[k], low[k]))
                                 for k in open_.tolist()], bool)

            last = np.array([float(min(w)) for w in low])
            first = np.array([float(max(w)) for w in tops])
            _rounds(block, np.maximum(last, first * (1 + LOW / 100) / 2), last, take, full)
            out = [(int(rid[asks[k]]), p, int(ids[rows[i]]), int(rid[rows[i]]), v)
                   for k, f in found.items() for p, hits in zip(tops[k], f) for i, v in hits]
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("arid", "positive_score", "nid", "nrid", "score"), cols)})
    return run


def mine_negatives(rows: DataFrame, anchors: Column | None = None, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``. ``anchors`` says which rows ask; default: ids divisible
    by 100. For each anchor and each of its first POSITIVES other rows of the
    same label, the first NEGATIVES rows of another label that score between
    LOW percent of the positive's score and all of it."""
    if anchors is None:
        anchors = rows[id_col] % 100 == 0
    spark = rows.sparkSession
    base = materialize(quantised(rows, id_col, vector_col, label_col, anchors), "negatives-rows")
    # squares a dimension: as many rows as dimensions, summed in each task first
    squares = (base.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x") * F.col("x")).alias("e"))
               .orderBy(F.desc("e"), "d").select("d").toPandas())
    order = squares["d"].to_numpy(np.int64)
    n = base.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("a")).first()
    row_blocks, anchor_blocks = -(-max(n["n"], 1) // ROW_BLOCK), -(-max(n["a"], 1) // ANCHOR_BLOCK)

    def grid(rows: DataFrame, asking: DataFrame) -> DataFrame:
        """Rows in every block of anchors, anchors in every block of rows."""
        def dealt(df, own, blocks, other):
            every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
            return df.withColumn(own, F.pmod(F.xxhash64("rid"), F.lit(row_blocks if own == "rb" else anchor_blocks)).cast("int")) \
                .withColumn(other, every)
        none = F.lit(None).cast("array<bigint>").alias("windows")
        left = dealt(rows.select("id", "label", "v", "rid", F.lit(False).alias("asks"), none), "rb", anchor_blocks, "ab")
        right = dealt(asking.select("id", "label", "v", "rid", F.lit(True).alias("asks"), "windows"), "ab", row_blocks, "rb")
        return left.unionByName(right).groupBy("rb", "ab")

    def first(df: DataFrame, window: list[str], ties: list[str], k: int) -> DataFrame:
        """The first k of a window; blocks gave at most k each."""
        w = Window.partitionBy(*window).orderBy(F.desc("score"), *ties)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    asking = base.where("anchor")
    none = F.lit(None).cast("array<bigint>").alias("windows")
    near = grid(base, asking.select("*", none)).applyInArrow(
        _positives(order), "arid long, pid long, prid long, score long")
    positives = materialize(first(near, ["arid"], ["pid", "prid"], POSITIVES).select("arid", "pid", "prid", "score"), "positives")
    windows = positives.where("score >= 0").groupBy("arid").agg(F.collect_set("score").alias("windows"))  # at most POSITIVES
    asking = asking.join(windows, asking["rid"] == windows["arid"]).drop("arid")
    far = grid(base, asking).applyInArrow(
        _negatives(order), "arid long, positive_score long, nid long, nrid long, score long")
    negatives = first(far, ["arid", "positive_score"], ["nid", "nrid"], NEGATIVES)
    known = lambda c: F.when(F.col(c) == LARGEST, F.lit(None)).otherwise(F.col(c))
    ids = base.where("anchor").select(F.col("rid").alias("arid"), F.col("id").alias("anchor_id"))
    return (positives.withColumnRenamed("score", "positive_score").join(negatives, ["arid", "positive_score"]).join(ids, "arid")
            .select("anchor_id", known("pid").cast("long").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    known("nid").cast("long").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
