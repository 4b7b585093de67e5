"""Operator 3's buckets: what one takes of memory, and the rows that it makes."""

import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from ferry.llm import suffix_dedup


def _bucket(n, texts, buckets, cell=2500):
    """A bucket's table: n anchors of so many texts, a half of them in two texts or more."""
    rng = np.random.default_rng(1)
    h, ck = rng.integers(0, 2 * n, n).astype(np.uint32), rng.integers(0, texts, n)
    at = range(0, n, cell)
    same = lambda x: pa.array([x] * len(at), pa.int32())
    return h, ck, pa.table({"bucket": same(3), "buckets": same(buckets), **{
        name: pa.array([x[i:i + cell].tobytes() for i in at], pa.binary()) for name, x in (("h", h), ("ck", ck))}})


def test_a_bucket_takes_little_memory():
    table = _bucket(suffix_dedup.BUCKET_BYTES // 18, 7000, 36)[2]
    tracemalloc.start()
    suffix_dedup._meet(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # 140 MB before


def test_a_bucket_makes_a_row_for_each_part():
    h, ck, table = _bucket(20000, 3000, 8)
    met = suffix_dedup._meet(table)
    assert met.num_rows <= 8  # a row for each text before
    texts = {}
    for x, c in zip(h.tolist(), ck.tolist()):
        texts.setdefault(x, set()).add(c)
    expected = {}
    for x, c in zip(h.tolist(), ck.tolist()):
        if len(texts[x]) > 1:
            expected.setdefault(c, set()).add(3 << 32 | x)
    got = {}
    for part in set(met.column("part").to_pylist()):
        found = suffix_dedup._marks_of_texts(met.filter(pa.compute.equal(met.column("part"), part)))
        for c, m in zip(found.column("ck").to_pylist(), found.column("marks").to_pylist()):
            assert c not in got
            got[c] = np.frombuffer(m, np.uint64).tolist()
    assert got == {c: sorted(x) for c, x in expected.items()}


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "BUCKET_SUFFIXES", 20)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcd éß\n") for _ in range(n))
    common, passages = text(200), [text(60) for _ in range(4)]
    rows = [(i, text(rng.randint(0, 150)) + rng.choice(passages) + text(rng.randint(0, 80))) for i in range(40)]
    rows += [(100 + i, common) for i in range(20)] + [(None, common), (200, None), (201, common + "x"), (7, common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == sorted(brute.repeats(rows), key=repr)
