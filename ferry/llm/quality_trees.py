"""Quality rules by gradient-boosted trees (operator 7).

Document statistics come from one pass over whole texts. A boosted ensemble
of shallow trees learns the quality label from them; every tree is flattened
into node arrays (feature, threshold, left, right, value), so scoring walks
all rows of a batch down a tree with a few numpy gathers. Chosen features are
monotone: a split that would let the score rise with the share of symbols,
repeats or copied lines is not taken, and the values of later splits stay
within the bounds that earlier ones set.

The trees are fitted on a sample of at most ``MAX_LABELLED`` labelled rows,
the ones with the smallest hash of their id; statistics cover every row. The
verdict's threshold comes from all labelled rows, scored by the fitted trees:
margins are counted in bins of 1 / ``CUT_BINS``, and the threshold is the
highest bin below which no more than ``GOOD_LOST`` of the good rows lie.

Rows: null text has no words (all statistics 0, base rules fail); repeated
rows are judged each; null ids take no part in training; a label table that
is empty or of one class gives a model that keeps what passes the base rules;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.textbatch import LOWER, MULT, SPACE, chunks, mix, span_hashes, utf8, words
from ferry.plans.sizing import materialize

MAX_LABELLED = 20_000
ROUNDS, DEPTH, RATE, BINS, L2, MIN_ROWS = 60, 3, 0.15, 32, 1.0, 20
#: Share of the good labelled rows that the threshold may lose.
GOOD_LOST = 0.01
#: Bins of a margin's unit, and the margins beyond which all count alike.
CUT_BINS, CUT_RANGE = 1000, 20
# The symbols of the base rule.
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_digits", "n_upper", "n_stops")
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
            "digit_share", "upper_share", "stop_share", "words_per_line")
#: +1: the score may only rise with the feature, -1: only fall.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(mask)])
    return c[off[1:]] - c[off[:-1]]


def statistics(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every row of a batch (COUNTS and EXTRA)."""
    solid = ~SPACE[data]
    starts, ends, wo = words(data, off)
    n_words = np.diff(wo)
    row = np.repeat(np.arange(len(off) - 1), n_words)
    salt = mix(np.arange(1, len(off), dtype=np.uint64) * MULT[0])
    h = span_hashes(data, starts, ends)
    # words in 3-word windows that occur twice or more
    full = np.zeros(len(h), bool)
    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        full[:-2] = row[2:] == row[:-2]
        at = np.flatnonzero(full)
        key = mix(h[at] * MULT[1] + h[at + 1] * MULT[2] + h[at + 2] * MULT[3]) ^ salt[row[at]]
        code, uniq = pd.factorize(key)
        again = at[np.bincount(code, minlength=len(uniq))[code] > 1]
        for j in range(3):
            covered[again + j] = True
    distinct = ~pd.Index(h ^ salt[row]).duplicated()
    # lines
    nl = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([off[:-1], nl + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    has_nl = data[line_end - 1] == 10 if len(line_end) else np.zeros(0, bool)
    line_end = line_end - has_nl
    c = np.concatenate([[0], np.cumsum(solid)])
    real = c[line_end] > c[line_start]
    ls, le = line_start[real], line_end[real]
    line_row = np.searchsorted(off, ls, "right") - 1
    dup = pd.Index(span_hashes(data, ls, le) ^ salt[line_row]).duplicated()
    n = len(off) - 1
    return {"n_words": n_words, "word_chars": _per_row(solid & ((data & 0xC0) != 0x80), off),
            "n_symbols": _per_row(_SYMBOL[data], off),
            "n_dup_lines": np.bincount(line_row[dup], minlength=n),
            "n_repeat_words": np.bincount(row[covered], minlength=n),
            "n_lines": np.bincount(line_row, minlength=n),
            "n_distinct": np.bincount(row[distinct], minlength=n),
            "n_digits": _per_row((data >= 48) & (data <= 57), off),
            "n_upper": _per_row(LOWER[data] != data, off),
            "n_stops": _per_row((data == 46) | (data == 33) | (data == 63), off)}


def features(t: dict[str, np.ndarray]) -> np.ndarray:
    w = np.maximum(t["n_words"], 1).astype(float)
    ch = np.maximum(t["word_chars"], 1).astype(float)
    lines = np.maximum(t["n_lines"], 1).astype(float)
    return np.column_stack([np.log1p(t["n_words"]), t["word_chars"] / w, t["n_symbols"] / ch,
                            t["n_dup_lines"] / lines, t["n_repeat_words"] / w, t["n_distinct"] / w,
                            t["n_digits"] / ch, t["n_upper"] / ch, t["n_stops"] / w, t["n_words"] / lines])


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = COUNTS + EXTRA
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            for lo, hi in chunks(off):
                t = statistics(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *[pa.array(t[c].astype(np.int64)) for c in names]],
                    names=["id", *names])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} long" for c in names))


@dataclass
class Trees:
    """Node arrays of all trees, tree after tree; ``root`` has their starts."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    base: float
    cut: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for r in self.root:
            node = np.full(len(x), r)
            for _ in range(DEPTH):
                down = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            out += self.value[node]
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees | None:
    """Boosted trees for a 0/1 label (logistic loss, second-order gains)."""
    if len(y) == 0 or y.min() == y.max():
        return None
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    p0 = y.mean()
    base = float(np.log(p0 / (1 - p0)))
    margin = np.full(len(y), base)
    sign = [MONOTONE.get(f, 0) for f in FEATURES]
    size = 2 ** (DEPTH + 1) - 1
    inner = 2 ** DEPTH - 1
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    for t in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(size, np.int64), np.full(size, np.inf)
        value = np.zeros(size)
        low, high = np.full(size, -np.inf), np.full(size, np.inf)
        here = np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(here == node)
            tg, th = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, 0, 0.0, 0.0)
            for f in range(x.shape[1]) if len(rows) >= 2 * MIN_ROWS else ():
                k = len(edges[f]) + 1
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=k))[:-1]
                lg = np.cumsum(np.bincount(b, g[rows], k))[:-1]
                lh = np.cumsum(np.bincount(b, h[rows], k))[:-1]
                vl = np.clip(lg / (lh + L2), low[node], high[node])
                vr = np.clip((tg - lg) / (th - lh + L2), low[node], high[node])
                gain = lg ** 2 / (lh + L2) + (tg - lg) ** 2 / (th - lh + L2) - tg ** 2 / (th + L2)
                ok = (n >= MIN_ROWS) & (len(rows) - n >= MIN_ROWS) & (sign[f] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -1)
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (gain[i], f, i, vl[i], vr[i])
            lc, rc = 2 * node + 1, 2 * node + 2
            low[lc] = low[rc] = low[node]
            high[lc] = high[rc] = high[node]
            if best[1] < 0:  # no split: all rows go left
                value[lc] = value[rc] = np.clip(tg / (th + L2), low[node], high[node])
                here[rows] = lc
                continue
            _, f, i, vl, vr = best
            feature[node], threshold[node] = f, edges[f][i]
            value[lc], value[rc] = vl, vr
            if sign[f]:
                mid = (vl + vr) / 2
                if sign[f] > 0:
                    high[lc], low[rc] = min(high[lc], mid), max(low[rc], mid)
                else:
                    low[lc], high[rc] = max(low[lc], mid), min(high[rc], mid)
            here[rows] = np.where(binned[rows, f] <= i, lc, rc)
        value *= RATE
        margin += value[here]
        start = t * size
        at = np.arange(size)
        last = at >= inner
        nodes["feature"].append(feature)
        nodes["threshold"].append(threshold)
        nodes["left"].append(start + np.where(last, at, 2 * at + 1))
        nodes["right"].append(start + np.where(last, at, 2 * at + 2))
        nodes["value"].append(value)
    flat = {k: np.concatenate(v) for k, v in nodes.items()}
    return Trees(**flat, root=np.arange(ROUNDS) * size, base=base, cut=0.0)


def threshold(trees: Trees, good: DataFrame) -> float:
    """The highest bound, zero at most, below which GOOD_LOST of the rows with
    these statistics lie at most."""
    names = COUNTS + EXTRA
    sent = good.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for b in batches:
            margin = sent.value.margin(features({c: b.column(c).to_numpy(zero_copy_only=False) for c in names}))
            bins = np.floor(np.clip(margin, -CUT_RANGE, CUT_RANGE) * CUT_BINS).astype(np.int64)
            bins, n = np.unique(bins, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n.astype(np.int64))], names=["bin", "n"])

    # at most 2 * CUT_RANGE * CUT_BINS + 1 rows
    bins = good.select(*names).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    if not len(bins):
        return 0.0
    bins = bins.sort_values("bin")
    before = np.cumsum(bins["n"].to_numpy()) - bins["n"].to_numpy()
    at = int(np.flatnonzero(before <= GOOD_LOST * bins["n"].sum())[-1])
    return min(0.0, float(bins["bin"].to_numpy()[at]) / CUT_BINS)


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(id, counts..., base_failed, kept, quality_score)`` of every row."""
    spark = docs.sparkSession
    stats = materialize(document_statistics(docs, id_col, text_col), "quality-statistics")
    known = (labels.select(labels[id_col].alias("id"), labels[label_col].cast("double").alias("y"))
             .filter("id is not null and y is not null")
             .groupBy("id").agg(F.max("y").alias("y")))
    # The sample: the smallest hashes, at most max_labelled rows.
    labelled = stats.join(known, "id")
    sample = labelled.orderBy(F.xxhash64("id"), "id").limit(max_labelled).toPandas()
    names = COUNTS + EXTRA
    model = fit(features({c: sample[c].to_numpy() for c in names}),
                (sample["y"].to_numpy() > 0).astype(float)) if len(sample) else None
    if model is not None:
        model.cut = threshold(model, labelled.where("y > 0"))
    sent = spark.sparkContext.broadcast(model)
    kind = stats.schema["id"].dataType.simpleString()

    def run(batches):
        trees = sent.value
        for b in batches:
            t = {c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
            failed = (t["n_words"] < 50) | (100 * t["n_repeat_words"] > 50 * t["n_words"])
            margin = trees.margin(features(t)) if trees is not None else np.zeros(b.num_rows)
            kept = ~failed & (margin >= (trees.cut if trees is not None else 0.0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(t[c]) for c in COUNTS], pa.array(failed), pa.array(kept),
                 pa.array(1 / (1 + np.exp(-margin)))],
                names=[id_col, *COUNTS, "base_failed", "kept", "quality_score"])

    return stats.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
                            + ", base_failed boolean, kept boolean, quality_score double")
