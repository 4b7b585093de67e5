"""The backoff automaton over many blocks and buckets, hot middle words divided."""

import brute
import numpy as np
import pytest
from test_whole_job import _backoff_scores, _zipf_rows

from ferry.llm import lm_automaton


@pytest.mark.parametrize("split", [60, 10 ** 9])
def test_walk_over_blocks_and_split_words(spark, monkeypatch, split):
    rows = _zipf_rows() + [(1000 + i, "c1 c1 c1 c2 c1") for i in range(30)] + [(2000 + i, "") for i in range(200)]
    rows += [(3000, " ".join(f"c{i % 7 + 1}" for i in range(5000)))]
    for name, value in (("BLOCK_TOKENS", 700), ("BUCKET_WORDS", 300), ("BUCKET_GRAMS", 900), ("SPLIT_TOKENS", split)):
        monkeypatch.setattr(lm_automaton, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).persist()
    got = sorted(((r["doc_id"], r["score"]) for r in lm_automaton.score_documents(docs).collect()), key=repr)
    expected = sorted(_backoff_scores(rows), key=repr)
    assert [d for d, _ in got] == [d for d, _ in expected]
    assert np.allclose([s for _, s in got], [s for _, s in expected])


def test_walk_takes_failure_arcs():
    """One text `a b c` learned; `a c` leaves the start's state by `a` and fails from (start, a) to (a) to the root."""
    seq = np.array([0, 1, 2, 3, 0, 2, 3], np.uint64)  # a b c end, a c end; 4 is the start
    block = lm_automaton.Block({
        "held": lm_automaton.pack(np.array([False, True])), "lens": lm_automaton.pack(np.array([4, 3])),
        "seq": lm_automaton.pack(seq.astype(np.uint32)), "numbers": lm_automaton.pack(np.array([0, 1, 1, 1, 1])),
        "n": lm_automaton.pack(np.array([1, 1, 1, 1, 1])), "start": 4})
    n = block.learned
    none = np.full(len(n), np.nan)
    known = block.middle == 2  # (c, end) follows the middle word c in the learned text
    model = lm_automaton.Automaton(block, n, np.ones(len(n), np.int64), np.full(len(n), -1.0), np.where(known, -0.25, none),
                                   np.full(len(n), -2.0), np.log10(4.5))
    half, one = np.log10(0.5), np.log10(1.1 / 4.5)
    assert np.allclose(model.walk(block.seq, block.lens), [4 * half, half - 1 - 2 + one - 0.25])


def test_clashing_columns_repeated_rows_and_no_training_rows(spark):
    rows = [("a", "x y z", 1), ("a", "x y z", 1), (None, None, 2), ("b", "  \n ", 3), ("c", "x " * 3000, 4)]
    docs = spark.createDataFrame([(*r, r[2], "t", 0.5) for r in rows],
                                 "`doc id` string, text string, rid int, block int, held_out string, score double")
    got = sorted(((r["doc id"], r["n_tokens"], r["score"]) for r in lm_automaton.score_documents(docs, "doc id").collect()), key=repr)
    expected = sorted(((d, s) for d, s in _backoff_scores([(d if d is not None else "", t) for d, t, _ in rows])), key=repr)
    assert sorted(n for _, n, _ in got) == [1, 1, 4, 4, 3001]
    assert np.allclose(sorted(s for _, _, s in got), sorted(s for _, s in expected))

    held = next(i for i in range(100) if brute.crc(i) % 10 == 0)
    alone = spark.createDataFrame([(held, "x y")], "doc_id long, text string")
    (row,) = lm_automaton.score_documents(alone).collect()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert np.isclose(row["base_score"], 0) and np.isclose(row["score"], 0)
