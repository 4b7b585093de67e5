"""The quality verdict: the trees walked node by node, and a threshold that
sees every labelled row, also those that the trees were not fitted on."""

import random

import numpy as np
from pyspark.sql import functions as F

from ferry.llm import quality_trees as qt


def _walk(trees, x):
    out = trees.base
    for root in trees.root:
        node = root
        for _ in range(qt.DEPTH):
            node = trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        out += trees.value[node]
    return out


def _docs(n=400):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        good = rng.random() < 0.6
        words = [f"w{rng.randrange(400 if good else 30)}" for _ in range(rng.randint(55, 120))]
        words += ["#$%"] * (0 if good else rng.randrange(20))
        rows.append((i if i % 40 else None, " ".join(words), int(good ^ (rng.random() < 0.05))))
    return rows


def test_verdict_by_walked_trees_and_all_labels(spark, monkeypatch):
    rows = _docs()
    docs = spark.createDataFrame([(d, t, 1) for d, t, _ in rows], "doc_id long, text string, y int").repartition(3)
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(5, None), (3, rows[3][2]), (None, 1)], "doc_id long, quality int")
    seen, real = [], qt.fit

    def fit(x, y):
        seen.append((x, y, real(x, y)))
        return seen[-1][2]
    monkeypatch.setattr(qt, "fit", fit)
    got = {r["doc_id"]: r for r in qt.judge_quality(docs, labels, max_labelled=120).collect() if r["doc_id"] is not None}
    x, y, trees = seen[0]
    assert len(y) == 120  # the bounded sample
    stats = {r["id"]: r for r in qt.document_statistics(docs, "doc_id", "text").collect()}
    names = qt.COUNTS + qt.EXTRA
    ids = [d for d, _, _ in rows if d is not None]
    every = qt.features({c: np.array([stats[d][c] for d in ids]) for c in names})
    margin = {d: _walk(trees, f) for d, f in zip(ids, every)}
    good = sorted(margin[d] for d, _, label in rows if d is not None and label)
    lost = sum(m < trees.cut for m in good)
    assert lost <= qt.GOOD_LOST * len(good) and trees.cut <= 0
    if trees.cut < 0:  # a bin higher would lose more
        assert sum(m < trees.cut + 1.001 / qt.CUT_BINS for m in good) > qt.GOOD_LOST * len(good) or \
            not any(trees.cut <= m < trees.cut + 1.001 / qt.CUT_BINS for m in good)
    for d in ids:
        assert np.isclose(got[d]["quality_score"], 1 / (1 + np.exp(-margin[d])))
        assert got[d]["kept"] == (not got[d]["base_failed"] and margin[d] >= trees.cut)


def test_one_class_and_no_labels_keep_what_passes(spark):
    rows = _docs(40)
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    for labels in (docs.select("doc_id", F.lit(1).alias("quality")), docs.select("doc_id", F.lit(1).alias("quality")).limit(0)):
        assert all(r["kept"] != r["base_failed"] for r in qt.judge_quality(docs, labels).collect())
