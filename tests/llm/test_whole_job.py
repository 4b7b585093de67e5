"""Cases in which an operator once did less than the whole job."""

import math
import random
from collections import Counter

import brute
import numpy as np

from ferry.llm import lm_automaton, ngram_join


def _chain():
    """Texts a, b, c: a and c are near copies of b, but not of each other."""
    b = [f"w{i}" for i in range(200)]
    a = b[:10] + ["x"] + b[11:60] + ["x"] + b[61:]
    c = b[:110] + ["y"] + b[111:160] + ["y"] + b[161:]
    return [" ".join(x) for x in (a, b, c)]


def test_near_copies_under_null_ids_link(spark):
    a, b, c = _chain()
    rows = [(7, a), (None, b), (9, c), (None, c + " tail"), (None, "alone under no id " * 3), (3, "something else entirely here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.near(rows)
    assert {x[2] for x in expected[:4]} == {7}
    got = [tuple(r) for r in ngram_join.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def _backoff_scores(rows):
    """(doc_id, score) by plain trigram backoff over every n-gram of the training rows."""
    seqs = [[0, *brute.WORD.findall((t or "").translate(brute.AZ)), 1] for _, t in rows]
    learn = [s for (d, _), s in zip(rows, seqs) if brute.crc(d) % 10]
    one = Counter(w for s in learn for w in s)
    two = Counter(p for s in learn for p in zip(s, s[1:]))
    three = Counter(p for s in learn for p in zip(s, s[1:], s[2:]))
    n, v = sum(one.values()) - one[0], len(one) - (0 in one)
    uni = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    after = {}
    for gram in [*two, *three]:
        after.setdefault(gram[:-1], []).append(gram[-1])

    def p(context, w):
        if not context:
            return uni(w)
        count, whole = (three, two[context]) if len(context) == 2 else (two, one[context[0]])
        if count[(*context, w)]:
            return (count[(*context, w)] - 0.5) / whole
        if context not in after:
            return p(context[1:], w)
        seen = after[context]
        left = 1 - sum(count[(*context, x)] - 0.5 for x in seen) / whole
        return max(left, 1e-9) / max(1 - sum(p(context[1:], x) for x in seen), 1e-9) * p(context[1:], w)

    return [(d, sum(math.log10(p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s)))) for (d, _), s in zip(rows, seqs)]


def _zipf_rows():
    """Frequent words, and ones rarer than 1e-4 of all tokens that come in fixed trigrams."""
    rng = random.Random(11)
    rows = []
    for i in range(300):
        words = [f"c{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(60)]
        j = rng.randrange(40)
        rows.append((i, " ".join([*words[:30], f"rare{j}", f"name{j}", f"tail{j}", *words[30:]])))
    return rows + [(None, "c1 c2 unseen rare3 name3 tail3"), (900, None), (901, "rare1"), (901, "rare1 name1 other")]


def test_every_ngram_is_in_the_model(spark, monkeypatch):
    rows = _zipf_rows()
    expected = sorted(_backoff_scores(rows), key=repr)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).persist()
    for share in (lm_automaton.HOT_SHARE, 5e-3):  # all cached, and few cached
        monkeypatch.setattr(lm_automaton, "HOT_SHARE", share)
        got = sorted(((r["doc_id"], r["score"]) for r in lm_automaton.score_documents(docs).collect()), key=repr)
        assert [d for d, _ in got] == [d for d, _ in expected]
        assert np.allclose([s for _, s in got], [s for _, s in expected])
