"""Suffix-array dedup of repeated byte strings (operator 3).

A byte goes if some 50-byte string that covers it also starts in a document
with a smaller id. Suffixes are sorted in Spark partitions, each by deep-
shallow sorting: multikey steps of eight bytes order them to a shallow depth,
and groups that are still tied there are ordered by a blind trie, which looks
at branching bytes on the way down and compares in full once at a leaf.
Longest common prefixes of neighbours then say which 50-byte strings are
equal.

Which suffixes: every 50-byte window selects the anchor (16 bytes) with the
smallest hash in it, a choice that depends on the window's bytes alone, so
equal windows select equal anchors. Anchors are dealt by hash; those of only
one text can't repeat and stop there. Around each remaining anchor the
suffixes to its right and, reversed, to its left are sorted: two windows that
hold the anchor at the same place are equal where both common prefixes reach
their ends. The sorted classes give every window's smallest document.

Equal texts are settled first: of a group only the rows with the smallest id
go on, the others lose everything when 50 bytes long. Anchors move as packed
arrays; a text sends each anchor once.

Rows: null text counts as empty; texts under 50 bytes lose nothing; a null id
counts as larger than any other; rows that repeat an id are no copies of each
other (no id is smaller); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.textbatch import MULT, chunks, give_back, in_sorted, lean, mix, utf8
from ferry.plans.sizing import materialize

LENGTH, ANCHOR = 50, 16
SIDE = LENGTH - ANCHOR          # bytes of a window beside its anchor, at most
PLACES = SIDE + 1               # places of the anchor in a window
SHALLOW_WORDS = 2               # multikey steps of eight bytes
#: Text bytes for each bucket of anchors, and anchors for each bucket of suffixes.
BUCKET_BYTES, BUCKET_SUFFIXES = 24 << 20, 150_000
#: Text bytes whose windows are looked at together; each takes some 80 bytes meanwhile.
WINDOW_BYTES = 1 << 18
LAST = (1 << 63) - 1


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, row) of the selected anchors of a batch of texts."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(data) - ANCHOR + 1
    word = _words(data, m + 8)
    h = mix(word[:m] * MULT[40] + word[8:m + 8] * MULT[41])
    best = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    width = 1
    while width * 2 <= PLACES:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[:n], best[PLACES - width:PLACES - width + n])
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    inside = np.arange(n) + LENGTH <= off[row + 1]
    at = np.unique((best[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64))
    # small hashes were selected: mixed again, they are even over the buckets
    return at, mix(h[at] * MULT[43]), np.searchsorted(off, at, "right") - 1


def _words(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    pad = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(n, np.uint64)
    for r in range(8):
        k = len(range(r, n, 8))
        out[r::8] = np.frombuffer(pad[r:r + 8 * k].tobytes(), "<u8")
    return out


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of distinct strings of equal length by a blind trie: inner nodes
    hold only the byte position at which their children differ."""
    root: list = [None, 0]  # leaf: [None, index]; inner: [position, {byte: node}]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while node[0] is not None:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = strings[node[1]]
        at = next(k for k in range(len(s)) if s[k] != other[k])
        parent, node = None, root
        while node[0] is not None and node[0] < at:
            parent, node = node, node[1][s[node[0]]]
        if node[0] == at:
            node[1][s[at]] = [None, i]
            continue
        fresh = [at, {other[at]: node, s[at]: [None, i]}]
        if parent is None:
            root = fresh
        else:
            parent[1][s[parent[0]]] = fresh
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] is None:
            out.append(node[1])
        else:
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
    return out


def sort_suffixes(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by (key, bytes), and each one's common prefix with the one
    before it (-1: another key)."""
    n, width = text.shape
    pad = -(-width // 8) * 8
    full = np.zeros((n, pad), np.uint8)
    full[:, :width] = text
    word = full.view(">u8").astype(np.uint64)
    order = np.lexsort((*[word[:, k] for k in reversed(range(SHALLOW_WORDS))], key))
    word, key = word[order], key[order]
    tied = np.zeros(n, bool)
    tied[1:] = (key[1:] == key[:-1]) & (word[1:, :SHALLOW_WORDS] == word[:-1, :SHALLOW_WORDS]).all(1)
    same = np.ones(n, bool)
    same[1:] = (word[1:, SHALLOW_WORDS:] == word[:-1, SHALLOW_WORDS:]).all(1)
    # deep groups: runs of ties in which not all rows are equal
    group = np.cumsum(~tied) - 1
    mixed = np.flatnonzero(np.bincount(group, tied & ~same) > 0) if n else np.zeros(0, int)
    if len(mixed):
        first = np.flatnonzero(~tied)
        last = np.append(first[1:], n)
        for g in mixed.tolist():
            a, b = int(first[g]), int(last[g])
            deep: dict[bytes, list[int]] = {}
            for i in range(a, b):
                deep.setdefault(text[order[i], 8 * SHALLOW_WORDS:].tobytes(), []).append(int(order[i]))
            strings = list(deep)
            order[a:b] = [i for k in blind_trie_order(strings) for i in deep[strings[k]]]
    t = text[order]
    lcp = np.full(n, -1)
    if n > 1:
        diff = t[1:] != t[:-1]
        some = diff.any(1)
        lcp[1:] = np.where(key[1:] == key[:-1], np.where(some, diff.argmax(1), width), -1)
    return order, lcp


def repeated_windows(key: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray,
                     left_cap: np.ndarray, right_cap: np.ndarray) -> np.ndarray:
    """For anchors with equal keys: a bit for each place o (bytes of the window
    before the anchor) whose window also starts in a smaller document.
    ``left`` is read away from the anchor; keys are the anchors' bytes."""
    by_doc = np.argsort(doc, kind="stable")
    key, doc, left, right = key[by_doc], doc[by_doc], left[by_doc], right[by_doc]
    left_cap, right_cap = left_cap[by_doc], right_cap[by_doc]
    n = len(key)
    lo, l_lcp = sort_suffixes(key, left)
    ro, r_lcp = sort_suffixes(key, right)
    found = np.zeros(n, np.uint64)
    l_class, r_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(PLACES):
        l_class[lo] = np.cumsum(l_lcp < o)
        r_class[ro] = np.cumsum(r_lcp < SIDE - o)
        at = np.flatnonzero((left_cap >= o) & (right_cap >= SIDE - o))
        code, uniq = pd.factorize(l_class[at] << 32 | r_class[at])
        first = np.empty(len(uniq), np.int64)
        first[code[::-1]] = at[::-1]  # rows go by document: the first one is the smallest
        hit = at[doc[at] > doc[first[code]]]
        found[hit] |= np.uint64(1 << o)
    out = np.empty(n, np.uint64)
    out[by_doc] = found
    return out


def covered(n: int, pos: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Mask of the bytes that the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    for o in range(PLACES):
        s = pos[(bits >> np.uint64(o)) & np.uint64(1) > 0] - o
        np.add.at(edge, s, 1)
        np.add.at(edge, s + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _buckets_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _short(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(4)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _lean_group(run):
    """``lean`` for a function of a group."""
    def group(table):
        try:
            return run(table)
        finally:
            give_back()
    return group


def _joined(column, kind) -> np.ndarray:
    """The numbers of all cells of a binary column; read where they are."""
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column])


def _meet(table):
    """A bucket's anchors that more than one text has, and these texts."""
    h = _joined(table.column("h"), np.uint32)
    order = np.argsort(h).astype(np.uint32)
    h, ck = h[order], _joined(table.column("ck"), np.int64)[order]
    del order
    same = h[1:] == h[:-1]
    # shared: not all of the anchor's texts are the first one
    start = np.append(0, np.flatnonzero(~same) + 1)
    shared = np.zeros(len(h), bool)
    shared[1:] = same & (ck[1:] != ck[:-1])
    shared = np.repeat(np.logical_or.reduceat(shared, start), np.diff(np.append(start, len(h))))
    del same, start
    h, ck = h[shared], ck[shared]
    # packed by a hash of the text: a row for each part, not for each text
    parts = int(table.column("buckets")[0].as_py())
    part = mix(ck.view(np.uint64) * MULT[45]) % np.uint64(parts)
    order = np.lexsort((ck, part))
    h, ck = h[order], ck[order]
    cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    used = np.flatnonzero(np.diff(cuts))
    return pa.table({"part": pa.array(used.astype(np.int32)),
                     "bucket": pa.array(np.full(len(used), table.column("bucket")[0].as_py(), np.int32)),
                     "h": pa.array([h[cuts[k]:cuts[k + 1]].tobytes() for k in used], pa.binary()),
                     "ck": pa.array([_packed(ck[cuts[k]:cuts[k + 1]]) for k in used], pa.binary())})


def _marks_of_texts(table):
    """A part's texts, each with its marks in order: its anchors of all buckets."""
    bucket = table.column("bucket").to_pylist()
    h = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("h")]
    mark = np.concatenate([x.astype(np.uint64) | np.uint64(b << 32) for x, b in zip(h, bucket)])
    ck = np.concatenate([_unpacked(x, np.int64, len(y)) for x, y in zip(table.column("ck"), h)])
    order = np.lexsort((mark, ck))
    mark, ck = mark[order], ck[order]
    fresh = np.append(True, (mark[1:] != mark[:-1]) | (ck[1:] != ck[:-1]))  # copies in other batches
    mark, ck = mark[fresh], ck[fresh]
    cut = np.append(0, np.flatnonzero(ck[1:] != ck[:-1]) + 1)
    end = np.append(cut[1:], len(ck))
    return pa.table({"ck": pa.array(ck[cut]), "marks": pa.array([mark[a:b].tobytes() for a, b in zip(cut, end)], pa.binary())})


def shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """``(ck, marks)``: of every text, its anchors that another text has too
    (packed 64-bit marks in order). ``rows`` has (text, ck)."""
    def emit(batches):
        for b in batches:
            data, off = utf8(b.column(0))
            ck = b.column(1).to_numpy()
            fresh = ~pd.Index(ck).duplicated()
            parts = []
            for lo, hi in chunks(off, WINDOW_BYTES):
                _, h, row = anchors(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                keep = fresh[lo:hi][row]
                parts.append((h[keep], ck[lo:hi][row[keep]]))
            h, own = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), ck[:0])
            once = ~pd.Index(h ^ mix(own.view(np.uint64) * MULT[42])).duplicated()
            h, own = h[once], own[once]
            order = np.argsort(h)
            h, own = h[order], own[order]
            cuts = np.searchsorted(_buckets_of(h, buckets), np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cuts))
            short = _short(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)),
                 pa.array([short[cuts[k]:cuts[k + 1]].tobytes() for k in used], pa.binary()),
                 pa.array([own[cuts[k]:cuts[k + 1]].tobytes() for k in used], pa.binary())],
                names=["bucket", "h", "ck"])

    cells = rows.select("text", "ck").mapInArrow(lean(emit), "bucket int, h binary, ck binary")
    met = (cells.withColumn("buckets", F.lit(buckets)).repartition(buckets, "bucket").groupBy("bucket")
           .applyInArrow(_lean_group(_meet), "part int, bucket int, h binary, ck binary"))
    return met.repartition(buckets, "part").groupBy("part").applyInArrow(_lean_group(_marks_of_texts), "ck long, marks binary")


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True)


def _unpacked(cell, kind, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(cell.as_buffer(), size, codec="zstd"), kind)


def _squeezed(texts: DataFrame) -> DataFrame:
    """``(z, size, ord, ck)``: texts as they travel through a shuffle."""
    def run(batches):
        for b in batches:
            data, off = utf8(b.column(0))
            z = [_packed(data[a:e]) for a, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.binary()), pa.array(np.diff(off)), b.column(1), b.column(2)],
                                             names=["z", "size", "ord", "ck"])

    return texts.select("text", "ord", "ck").mapInArrow(lean(run), "z binary, size long, ord long, ck long")


def _restored(b) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a batch whose first columns are (z, size)."""
    size = b.column(1).to_numpy()
    parts = [_unpacked(z, np.uint8, int(n)) for z, n in zip(b.column(0), size)]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)), np.concatenate([[0], np.cumsum(size)])


def _contexts(rows: DataFrame, buckets: int, cells: int) -> DataFrame:
    """Packed anchors with their surroundings, of ``rows`` (z, size, ord, ck, marks)."""
    def emit(batches):
        for b in batches:
            data, off = _restored(b)
            ords, cks = b.column(2).to_numpy(), b.column(3).to_numpy()
            marks = b.column(4)
            for lo, hi in chunks(off):
                d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                at, h, row = anchors(d, o)
                if not len(at):
                    continue
                mark = _short(h).astype(np.uint64) | _buckets_of(h, buckets).astype(np.uint64) << np.uint64(32)
                cut = np.searchsorted(row, np.arange(len(o)))
                keep = np.zeros(len(at), bool)
                for r in range(len(o) - 1):
                    if cut[r] < cut[r + 1]:
                        own = np.frombuffer(marks[lo + r].as_buffer(), np.uint64)
                        keep[cut[r]:cut[r + 1]] = in_sorted(own, mark[cut[r]:cut[r + 1]])[1]
                at, h, row = at[keep], h[keep], row[keep]
                order = np.argsort(h)
                at, h, row = at[order], h[order], row[order]
                if not len(at):
                    continue
                pad = np.concatenate([np.zeros(SIDE, np.uint8), d, np.zeros(SIDE, np.uint8)])
                around = pad[at[:, None] + np.arange(SIDE + ANCHOR + SIDE)]
                l_cap = np.minimum(at - o[row], SIDE).astype(np.uint8)
                r_cap = np.minimum(o[row + 1] - at - ANCHOR, SIDE).astype(np.uint8)
                place = (at - o[row]).astype(np.uint32)
                cell = _buckets_of(h, cells)
                cuts = np.searchsorted(cell, np.arange(cells + 1))
                used = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)),
                     *[pa.array([_packed(x[cuts[k]:cuts[k + 1]]) for k in used], pa.binary())
                       for x in (ords[lo:hi][row], cks[lo:hi][row], place, l_cap, r_cap, around)],
                     pa.array(np.diff(cuts)[used].astype(np.int32))],
                    names=["cell", "ord", "ck", "pos", "l", "r", "around", "n"])

    return rows.select("z", "size", "ord", "ck", "marks").mapInArrow(
        lean(emit), "cell int, ord binary, ck binary, pos binary, l binary, r binary, around binary, n int")


def _decide(table):
    kinds = {"ord": np.int64, "ck": np.int64, "pos": np.uint32, "l": np.uint8, "r": np.uint8, "around": np.uint8}
    count = table.column("n").to_pylist()
    col = {c: np.concatenate([_unpacked(x, t, n * (SIDE + ANCHOR + SIDE if c == "around" else 1))
                              for x, n in zip(table.column(c), count)]) for c, t in kinds.items()}
    around = col["around"].reshape(-1, SIDE + ANCHOR + SIDE)
    gram = np.ascontiguousarray(around[:, SIDE:SIDE + ANCHOR]).view(np.uint64)
    # the anchor's bytes, exactly: numbered pairs of eight bytes
    key = pd.factorize(pd.factorize(gram[:, 0])[0].astype(np.int64) << 32 | pd.factorize(gram[:, 1])[0])[0]
    first = np.empty(key.max() + 1 if len(key) else 0, np.int64)
    first[key] = col["ord"]
    many = (np.bincount(key, col["ord"] != first[key]) > 0)[key] if len(key) else np.zeros(0, bool)
    ords, ck, pos = col["ord"][many], col["ck"][many], col["pos"][many]
    bits = np.zeros(0, np.uint64)
    if len(ords):
        near = around[many]
        bits = repeated_windows(key[many], ords, near[:, :SIDE][:, ::-1], near[:, SIDE + ANCHOR:],
                                col["l"][many], col["r"][many])
    hit = np.flatnonzero(bits > 0)
    return pa.table(_by_part(ords[hit], ck[hit], pos[hit], bits[hit], int(table.column("parts")[0].as_py())))


def _by_part(ords, ck, pos, bits, parts: int) -> dict:
    """Found windows packed by a hash of their document."""
    part = (mix(ords.view(np.uint64) * MULT[44] ^ ck.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(cuts))
    cells = {n: pa.array([_packed(x[order][cuts[k]:cuts[k + 1]]) for k in used], pa.binary())
             for n, x in (("ord", ords), ("ck", ck), ("pos", pos), ("bits", bits))}
    return {"part": pa.array(used.astype(np.int32)), **cells, "n": pa.array(np.diff(cuts)[used].astype(np.int32))}


def _by_document(table):
    """(ord, ck, pos, bits) of each document of a part."""
    kinds = {"ord": np.int64, "ck": np.int64, "pos": np.uint32, "bits": np.uint64}
    count = table.column("n").to_pylist()
    col = {c: np.concatenate([_unpacked(x, t, n) for x, n in zip(table.column(c), count)]) for c, t in kinds.items()}
    order = np.lexsort((col["ck"], col["ord"]))
    ords, ck, pos, bits = (col[c][order] for c in kinds)
    cut = np.append(0, np.flatnonzero((ords[1:] != ords[:-1]) | (ck[1:] != ck[:-1])) + 1)
    end = np.append(cut[1:], len(ords))
    return pa.table({"ord": pa.array(ords[cut]), "ck": pa.array(ck[cut]),
                     "pos": pa.array([pos[a:b].tobytes() for a, b in zip(cut, end)], pa.binary()),
                     "bits": pa.array([bits[a:b].tobytes() for a, b in zip(cut, end)], pa.binary())})


def _removed(batches):
    for b in batches:
        data, off = _restored(b)
        removed, spans, kept = [], [], []
        for i, (p, w) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist())):
            text = data[off[i]:off[i + 1]]
            mask = covered(len(text), np.frombuffer(p, np.uint32).astype(np.int64), np.frombuffer(w, np.uint64))
            removed.append(int(mask.sum()))
            spans.append(int((mask & ~np.concatenate([[False], mask[:-1]])).sum()))
            kept.append(hashlib.sha256(text[~mask].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(2), b.column(5), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                          pa.array(kept, pa.string())], names=["ord", "ck", "removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    body = F.encode(F.coalesce(docs[text_col], F.lit("")), "UTF-8")
    sha = F.sha2(body, 256)
    ck = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    order = F.coalesce(docs[id_col].cast("long"), F.lit(LAST))
    texts = docs.select(docs[text_col].alias("text"), order.alias("ord"), ck.alias("ck"))
    facts = materialize(docs.select(docs[id_col].alias("id"), order.alias("ord"), ck.alias("ck"), sha.alias("sha"),
                                    F.octet_length(body).cast("long").alias("n")), "suffix-facts")
    least = facts.groupBy("sha").agg(F.min("ord").alias("least"))
    size = facts.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = int(max(8, -(-size // BUCKET_BYTES)))
    shared = materialize(shared_anchors(texts, buckets), "suffix-shared")
    # Only the first rows of a group of equal texts go on; the key holds the id, so copies spread.
    first = (facts.join(least, "sha").filter("ord = least").select("ck", "ord").distinct())
    todo = shared.join(first, "ck")
    total = (shared.agg(F.sum(F.octet_length("marks").cast("long")).alias("n")).first()["n"] or 0) // 8
    cells = int(max(8, -(-total // BUCKET_SUFFIXES)))
    rows = _squeezed(texts).join(todo, ["ck", "ord"])
    found = (_contexts(rows, buckets, cells).withColumn("parts", F.lit(cells)).repartition(cells, "cell").groupBy("cell")
             .applyInArrow(_lean_group(_decide), "part int, ord binary, ck binary, pos binary, bits binary, n int")
             .repartition(cells, "part").groupBy("part")
             .applyInArrow(_lean_group(_by_document), "ord long, ck long, pos binary, bits binary"))
    hits = (_squeezed(texts).join(found, ["ord", "ck"]).select("z", "size", "ord", "pos", "bits", "ck")
            .mapInArrow(lean(_removed), "ord long, ck long, removed long, spans long, kept string")
            .dropDuplicates(["ord", "ck"]))
    copy = (F.col("ord") > F.col("least")) & (F.col("n") >= LENGTH)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (facts.join(least, "sha").join(hits, ["ord", "ck"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
                    F.when(copy, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(copy, none).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256")))
