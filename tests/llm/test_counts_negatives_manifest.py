"""Token counts, hard negatives and the Merkle manifest against plain Python,
and every SQL of this folder against its query."""

import hashlib
import math
import random
import struct
import unicodedata
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from ferry.llm import hard_negatives, merkle_manifest, queries, token_counts
from ferry.llm.textbatch import utf8

WORD_FILE = public_tokenizers.path(queries.WORD_TOKENIZER)
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "'s", "'re", "'", "1", "23", "!", "<|", "|>", "<|endoftext|>", "<|startoftext|>",
         "é", "É", "ß", "İ", "Σ", "漢", "🙂", "é", "̸", " ", "…", "“", "ﬁ", "don't", "'LL", "-----", "aaaaaaaa",
         "क्षि", "‍", "한", "ᄒ", "ᅡ"]


def _texts():
    rng = random.Random(3)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return [*mixed, "".join(rng.choice("abcdefgh") for _ in range(700)), "z" * 3000, "", " ", None,
            "word " * 900, "!<|endoftext|", "x'<|endoftext|>'re"]


def test_counts_at_every_prefix():
    tok, own = Tokenizer.from_file(WORD_FILE), token_counts.counter(WORD_FILE)
    texts = [t or "" for t in _texts()]
    counts, form, off = own.prefix_counts(*utf8(pa.array(texts)))
    seen = 0
    for t, lo, hi in zip(texts, off[:-1], off[1:]):
        normal, at = form[lo:hi].tobytes().decode(), int(lo)
        for k, ch in enumerate(normal[:300]):
            at += len(ch.encode())
            prefix = normal[:k + 1]
            if unicodedata.normalize("NFC", prefix) == prefix:
                assert counts[at - 1] == len(tok.encode(prefix, add_special_tokens=False).ids), prefix
                seen += 1
        if len(normal):
            assert counts[hi - 1] == len(tok.encode(t, add_special_tokens=False).ids)
    assert seen > 8000


def test_classes_are_the_librarys():
    cut, kinds = Tokenizer.from_file(WORD_FILE).pre_tokenizer, token_counts.counter(WORD_FILE).classes
    for c in [*range(0x600), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0x1F600, 0x1D7CE]:
        ch = chr(c)
        shape = (len(cut.pre_tokenize_str(ch + ch)), len(cut.pre_tokenize_str("x" + ch + "x")))
        expected = {(1, 1): token_counts.LETTER, (2, 3): token_counts.NUMBER, (0, 2): token_counts.SPACE_}.get(shape, token_counts.OTHER)
        assert kinds[c] == expected, hex(c)


def test_count_documents(spark, monkeypatch):
    tok = Tokenizer.from_file(WORD_FILE)
    rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(_texts())]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, n_tokens int").repartition(3).persist()
    limit = 20
    for size in (token_counts.PART_BYTES, 64):  # whole texts, and parts cut before spaces
        monkeypatch.setattr(token_counts, "PART_BYTES", size)
        monkeypatch.setattr(token_counts.parts, "__defaults__", (size,))
        got = token_counts.count_documents(docs, WORD_FILE, limit).collect()
        expected = []
        for d, t, *_ in rows:
            n = len(tok.encode(t or "", add_special_tokens=False).ids)
            expected.append((d, len((t or "").encode()), n, n > limit))
        assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(expected, key=repr)
    assert token_counts.count_documents(docs.limit(0), WORD_FILE).count() == 0


def test_budgets_without_the_texts(spark):
    tok = Tokenizer.from_file(WORD_FILE)
    texts = {1: "the ring of the stones " * 30, 2: "antidisestablishmentarianism", 3: "", 4: "Öl " * 40 + "x" * 90}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    store = token_counts.prefix_store(docs, WORD_FILE)
    asked = [(d, f"{b}", b, None) for d in texts for b in (0, 1, 3, 17, 10_000)] + [(1, "at", None, 30), (4, "cut", None, 1), (4, "at", None, 2)]
    got = {(r["doc_id"], r["question"]): r for r in token_counts.answer(
        store, spark.createDataFrame(asked, "doc_id long, question string, budget long, at_byte long")).collect()}
    assert len(got) == len(asked)
    for d, name, budget, at in asked:
        low, r = texts[d].lower(), got[d, name]
        size = lambda s: len(tok.encode(s, add_special_tokens=False).ids)
        if budget is not None:
            fits = max(k for k in range(len(low) + 1) if size(low[:k]) <= budget)
            assert r["fitting_bytes"] == len(low[:fits].encode()) and r["tokens"] is None
        else:
            raw = low.encode()[:at]
            whole = raw.decode(errors="ignore").encode() == raw
            assert r["tokens"] == (size(raw.decode()) if whole else None)
    fit = {r["doc_id"]: r["fitting_bytes"] for r in token_counts.count_documents(docs, WORD_FILE, 17).collect()}
    assert all(fit[d] == got[d, "17"]["fitting_bytes"] for d in texts)


# ------------------------------------------------------------ hard negatives
def _negatives(rows):
    clip = lambda x: max(-2 ** 63, min(2 ** 63 - 1, x))
    ok = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((k, i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, i, v, label in ok:
        if i is None or i % 100:
            continue
        scores = [(clip(sum(x * y for x, y in zip(v, w))), j, n) for m, j, w, n in ok if m != k]
        for p in sorted([s for s in scores if s[2] == label], key=key)[:5]:
            hits = sorted([s for s in scores if s[2] != label and 80 * p[0] <= 100 * s[0] <= 100 * p[0]], key=key)[:5]
            out += [(i, p[1], r + 1, s[1], p[0], s[0]) for r, s in enumerate(hits)]
    return out


def _vectors():
    rng = random.Random(4)
    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    centres = [[rng.gauss(0, .2) for _ in range(16)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, .1) for c in rng.choice(centres)], rng.randrange(10)) for i in range(700)]
    rows += [(i, [0.5] * 16, i % 3) for i in range(700, 900)]  # a hot vector: ties
    rows += [(1800, None, 1), (1900, [None, 1.0], 1), (2000, [float("nan")] * 16, 2), (2100, [float("inf")] * 3, 2), (2200, [], 3),
             (2300, [0.1] * 16, None), (None, [0.5] * 16, 1), (100, rows[100][1], 4), (100, rows[100][1], rows[100][2]),
             (2400, [0.2] * 20, 5), (2500, [-0.0] * 16, 6), (2600, [-1.0] * 16, 7), (None, None, None)]
    return [(i, v and [None if x is None else single(x) for x in v], n) for i, v, n in rows]


SCHEMA = "vec_id long, embedding array<float>, label int, id string, score int"


@pytest.mark.parametrize("rows_a_block, anchors_a_block", [(32_768, 2_048), (200, 4)])
def test_hard_negatives(spark, monkeypatch, rows_a_block, anchors_a_block):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", rows_a_block)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", anchors_a_block)
    rows = _vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in hard_negatives.mine_negatives(hard_negatives.relabelled(df)).collect()]
    assert sorted(got, key=repr) == sorted(_negatives(rows), key=repr) and len(got) > 100


def test_hard_negatives_of_huge_vectors_and_none(spark):
    rng = random.Random(9)
    rows = [(i, [struct.unpack("f", struct.pack("f", rng.uniform(-1, 1) * 10.0 ** rng.randint(0, 30)))[0] for _ in range(5)], i % 2)
            for i in range(0, 600, 20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in hard_negatives.mine_negatives(hard_negatives.relabelled(df)).collect()]
    assert sorted(got) == sorted(_negatives(rows)) and got
    assert hard_negatives.mine_negatives(df.limit(0)).count() == 0


def test_index_omits_and_still_finds():
    rng = np.random.default_rng(2)
    scale = 2.0 ** -np.arange(40)
    x, q = (np.floor(rng.normal(size=(n, 40)) * scale * 1000) for n in (500, 6))
    make = lambda a: hard_negatives.Vectors((a.ravel(), np.arange(0, a.size + 1, 40)), np.arange(len(a)), np.arange(40))
    block, which = hard_negatives.Block(make(x), make(q)), np.arange(6)
    for share in (0.5, 0.1, -0.2):
        least = share * block.bound()
        a, r, s = block.scores_from(which, least)
        full = q @ x.T
        assert set(zip(a.tolist(), r.tolist())) == set(zip(*(i.tolist() for i in np.nonzero(full >= least[:, None]))))
        assert (full[a, r] == s).all()


# ------------------------------------------------------------------- manifest
def _manifest(rows):
    def digest(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def way(tree, i):
        steps = []
        for nodes in tree[:-1]:
            first = i // 3 * 3
            steps.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 3])))
            i //= 3
        return steps

    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0], digest(*map(field, r)), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    trees = {s: levels([t[1] for t in by_source[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (d, leaf, r) in enumerate(by_source[s]):
            steps, text = way(trees[s], i) + way(top, k), r[4]
            if text is not None and zlib.crc32(("" if d is None else str(d)).encode()) % 2 == 0:
                text = text.replace("\n", "")
            got = digest(*map(field, (*r[:4], text)))
            for lo, hi in steps:
                got = digest(lo, got, hi)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], digest(*[a + b for a, b in steps]), got, got == top[-1][0]))
    return out


@pytest.mark.parametrize("digits", [6, 2])
def test_merkle_manifest(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle_manifest, "DIGITS", digits)
    rng = random.Random(1)
    rows = [(i if i % 50 else None, rng.choice([None, "a", "a", "a", "é", "z"]) if i < 500 else f"s{i}", rng.choice(["en", None]), i,
             rng.choice(["x\ny", "plain", None, "\n", ""])) for i in range(600)]
    rows += [rows[3]] * 5 + [(7, "only", None, None, "long\n" * 5000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, rank string, h string")
    got = [tuple(r)[:7] for r in merkle_manifest.manifest(df.repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(_manifest(rows), key=repr)
    assert {True, False} == {r[6] for r in got}


def test_merkle_manifest_of_one_row_and_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(None, None, None, None, None)]
    assert [tuple(r)[:7] for r in merkle_manifest.manifest(spark.createDataFrame(one, schema)).collect()] == _manifest(one)
    assert merkle_manifest.manifest(spark.createDataFrame([], schema)).count() == 0


# ------------------------------------------------------------------------ SQL
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    result = con.execute(queries.ORACLE[name])
    columns, expected = [c[0] for c in result.description], result.fetchall()
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(expected, key=repr)
