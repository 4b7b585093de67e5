"""LM scoring with a weighted backoff automaton (operator 10).

Tokens are lower-cased words and one end token. The model is a trigram model
with absolute discounting over every word, bigram and trigram of all training
rows. Its automaton has a state for each context of two words, of one word,
and the root. An arc (state, word) exists where the training rows hold that
n-gram; it has the discounted log-probability and leads to the state of the
last two words. A state without the arc fails to the state of its shorter
context and pays its backoff weight; the root has the add-0.1 unigrams. A text
is scored in one traversal from left to right that carries the state.

The texts are cut into blocks of whole rows. A block never sees the whole
automaton, only the slice that its texts can reach:

1. blocks send their distinct words with training counts to buckets of the
   words' hash, and get back numbers (frequent words have small ones) and
   counts over all rows;
2. they send their distinct trigrams, sorted, as deltas of word numbers, to
   buckets of the middle word. There every count of the trigram, of both its
   bigrams and of the middle word is complete, and the answer is in the order
   asked: counts for trigrams that exist, for the others the backoff weights
   and the bigram's log-probability;
3. a block builds its states and arcs from the answers and walks its texts.

A hot middle word has several buckets, chosen by the first word (by the last,
where the middle is the start of a text); the totals of its bigrams and of the
word come from a grouping of their own and go to those buckets as further
cells. What is broadcast is at most 1 / HOT_SHARE words. A word is known by its 64-bit hash.

Rows: null text counts as empty (the end token alone); repeated rows count
and are scored each; null ids count as the empty text in the split; without
training rows every token has count 0; an empty table gives an empty result.
A text is never divided: one longer than a block is a block of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.textbatch import LOWER, chunks, give_back, in_sorted, lean, mix, span_hashes, utf8, words
from ferry.plans.sizing import materialize

#: A middle word with more tokens than SPLIT_TOKENS and this share of all gets several buckets.
HOT_SHARE = 1e-6
ADD, DISCOUNT, LEAST = 0.1, 0.5, 1e-9
END_WORD, START_WORD = np.uint64(0x5E7D), np.uint64(0x57A7)  # not hashes of words, but by chance of 2^-64
#: Tokens of a block of texts.
BLOCK_TOKENS = 1_500_000
#: Distinct words of blocks for each bucket of words, and tokens for each bucket of trigrams.
BUCKET_WORDS, BUCKET_GRAMS = 1_000_000, 1_200_000
#: Tokens of a hot word for each of its buckets.
SPLIT_TOKENS = 300_000
SHIFT, LOW = np.uint64(32), np.uint64((1 << 32) - 1)


def training(id_col: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 10 != 0


def pack(x: np.ndarray) -> bytes:
    """The bytes of an array by place of the byte, compressed."""
    x = np.ascontiguousarray(x)
    return zstandard.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())


def unpack(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.decompress(b), np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.int64))


def _sums(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    return np.rint(np.bincount(at, n, size)).astype(np.int64)


def _hashed(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, lower-cased, and offsets by row."""
    data, off = utf8(column)
    hs, wo = [], [np.zeros(1, np.int64)]
    total = 0
    for lo, hi in chunks(off):
        d, o = LOWER[data[off[lo]:off[hi]]], off[lo:hi + 1] - off[lo]
        s, e, w = words(d, o)
        hs.append(span_hashes(d, s, e))
        wo.append(w[1:] + total)
        total += len(s)
    return (np.concatenate(hs) if hs else np.zeros(0, np.uint64)), np.concatenate(wo)


def _with_ends(h: np.ndarray, wo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes with the end token behind every row, and the rows' lengths."""
    lens = np.diff(wo) + 1
    seq = np.full(int(lens.sum()), END_WORD)
    own = np.repeat(np.arange(len(lens)), lens - 1)
    seq[np.arange(len(h)) + own] = h
    return seq, lens


def text_blocks(src: DataFrame) -> DataFrame:
    """One row for each block: (block, ids, held, lens, seq, words, n, vocab, tokens).
    ``seq`` has the place in ``words`` of every token, ``n`` the words' counts in
    the block's training rows; START_WORD's is the number of those rows."""
    def block(kept):
        first, ids, held = kept[0][0], pa.concat_arrays([k[1] for k in kept]), np.concatenate([k[2] for k in kept])
        seq, lens = (np.concatenate([k[i] for k in kept]) for i in (3, 4))
        u, code, many = np.unique(seq, return_inverse=True, return_counts=True)
        learn = np.repeat(~held, lens)
        n = np.bincount(code[learn], minlength=len(u))
        order = np.argsort(-many, kind="stable")
        place = np.empty(len(u), np.uint32)
        place[order] = np.arange(len(u))
        row = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays(
            [_long([first]), row, pa.array([pack(held)]), pa.array([pack(lens)]), pa.array([pack(place[code])]),
             pa.array([np.append(u[order], START_WORD).tobytes()]), pa.array([pack(np.append(n[order], (~held).sum()))]),
             _long([len(u) + 1]), _long([learn.sum()])],
            names=["block", "ids", "held", "lens", "seq", "words", "n", "vocab", "tokens"])

    def run(batches):
        kept, size = [], 0
        for b in batches:
            first = b.column(3).to_numpy()
            held = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            h, wo = _hashed(b.column(0))
            for lo, hi in chunks(wo, BLOCK_TOKENS):
                many = int(wo[hi] - wo[lo]) + hi - lo
                if kept and size + many > BLOCK_TOKENS:
                    yield block(kept)
                    kept, size = [], 0
                kept.append((int(first[lo]), b.column(1).slice(lo, hi - lo), held[lo:hi],
                             *_with_ends(h[wo[lo]:wo[hi]], wo[lo:hi + 1] - wo[lo])))
                size += many
        if kept:
            yield block(kept)

    kind = src.schema["id"].dataType.simpleString()
    return src.select("text", "id", "held_out", "rid").mapInArrow(
        lean(run), f"block long, ids array<{kind}>, held binary, lens binary, seq binary, words binary, n binary, "
                   "vocab long, tokens long")


def _by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket, and the buckets' bounds in it."""
    if buckets <= 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by radix
    order = np.argsort(bucket, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def number_words(blocks: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """The blocks with their words as numbers, ascending: (block, ids, held,
    lens, seq, numbers, n, start, parts, distinct), ``n`` counted over all rows and
    ``distinct`` the known words of every bucket in ``parts``."""
    def asked(batches):
        for b in batches:
            for block, h, n in zip(*(c.to_pylist() for c in b.columns)):
                h, n = np.frombuffer(h, np.uint64), unpack(n, np.int64)
                order, cut = _by_bucket((mix(h) % np.uint64(buckets)).astype(np.int64), buckets)
                used = np.flatnonzero(np.diff(cut))
                cells = [order[cut[i]:cut[i + 1]] for i in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), _long([block] * len(used)), pa.array([h[c].tobytes() for c in cells]),
                     pa.array([pack(n[c]) for c in cells])], names=["part", "block", "words", "n"])

    def reply(table):
        part = table.column("part")[0].as_py()
        hs = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        u, inv = np.unique(np.concatenate(hs), return_inverse=True)
        total = _sums(inv, np.concatenate([unpack(x, np.int64) for x in table.column("n").to_pylist()]), len(u))
        number = np.empty(len(u), np.int64)
        number[np.argsort(-total, kind="stable")] = part + buckets * np.arange(len(u))
        cuts = np.cumsum([0, *map(len, hs)])
        cells = [inv[a:b] for a, b in zip(cuts, cuts[1:])]
        out = pa.table({"block": table.column("block"), "part": table.column("part"),
                        "numbers": pa.array([pack(number[c]) for c in cells]), "n": pa.array([pack(total[c]) for c in cells]),
                        "distinct": _long([((total > 0) & (u != START_WORD)).sum()] * len(cells))})
        give_back()
        return out

    def numbered(block, got):
        h = np.frombuffer(block.column("words")[0].as_py(), np.uint64)
        order, cut = _by_bucket((mix(h) % np.uint64(buckets)).astype(np.int64), buckets)
        number, n = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        for part, *cell in zip(*(got.column(c).to_pylist() for c in ("part", "numbers", "n"))):
            at = order[cut[part]:cut[part + 1]]
            number[at], n[at] = (unpack(x, np.int64) for x in cell)
        order = np.argsort(number)
        place = np.empty(len(h), np.uint32)
        place[order] = np.arange(len(h))
        one = pa.array([0, got.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(one, got.column(c).combine_chunks()) for c in ("part", "distinct")]
        out = pa.table([*(block.column(c) for c in ("block", "ids", "held", "lens")),
                        pa.array([pack(place[unpack(block.column("seq")[0].as_py(), np.uint32)])]),
                        pa.array([pack(deltas(number[order]))]), pa.array([pack(n[order])]), _long([place[-1]]), *lists],
                       names=["block", "ids", "held", "lens", "seq", "numbers", "n", "start", "parts", "distinct"])
        give_back()
        return out

    kind = blocks.schema["ids"].dataType.simpleString()
    replies = (blocks.select("block", "words", "n")
               .mapInArrow(lean(asked), "part int, block long, words binary, n binary").repartition(buckets, "part")
               .groupBy("part").applyInArrow(reply, "block long, part int, numbers binary, n binary, distinct long"))
    sent = blocks.select("block", "ids", "held", "lens", "seq", "words").repartition(partitions, "block")
    return sent.groupBy("block").cogroup(replies.repartition(partitions, "block").groupBy("block")).applyInArrow(
        numbered, f"block long, ids {kind}, held binary, lens binary, seq binary, numbers binary, n binary, start long, "
                  "parts array<int>, distinct array<long>")


class Block:
    """A block's texts and its distinct trigrams, ascending by (middle, last, first)
    word; with ``after``, only those whose middle word is among these numbers."""

    def __init__(self, row: dict, after: np.ndarray | None = None):
        self.held, self.lens = unpack(row["held"], bool), unpack(row["lens"], np.int64)
        self.seq = unpack(row["seq"], np.uint32).astype(np.uint64)
        self.numbers, self.n = np.cumsum(unpack(row["numbers"], np.int64)), unpack(row["n"], np.int64)
        self.start = np.uint64(row["start"])
        full = np.full(len(self.seq) + 2 * len(self.lens), self.start)
        at = np.arange(len(self.seq)) + 2 * (np.repeat(np.arange(len(self.lens)), self.lens) + 1)
        full[at] = self.seq
        learn = np.repeat(~self.held, self.lens)
        if after is not None:
            take = in_sorted(after, self.numbers)[1][full[at - 1].astype(np.int64)]
            at, learn = at[take], learn[take]
        self.pairs, self.pair_of = np.unique(full[at - 1] << SHIFT | full[at], return_inverse=True)
        gram, self.gram_of = np.unique(self.pair_of.astype(np.uint64) << SHIFT | full[at - 2], return_inverse=True)
        self.pair = (gram >> SHIFT).astype(np.int64)
        self.first, self.middle, self.last = gram & LOW, self.pairs[self.pair] >> SHIFT, self.pairs[self.pair] & LOW
        self.learned = np.bincount(self.gram_of[learn], minlength=len(self.pair))  # in the block's training rows

    def contexts(self) -> np.ndarray:
        """The pair of words that each trigram begins with; -1 for the start of a text (all trigrams)."""
        before = np.empty(len(self.pair_of), np.int64)
        before[1:] = self.pair_of[:-1]
        before[np.cumsum(self.lens) - self.lens] = -1
        context = np.empty(len(self.pair), np.int64)
        context[self.gram_of] = before
        return context


@dataclass(frozen=True)
class Buckets:
    """Where a trigram is counted: by its middle word, a hot one's also by its first word."""

    many: int
    hot: np.ndarray      # numbers, ascending
    splits: np.ndarray   # buckets of each
    after: np.ndarray    # tokens, kinds and unigram mass behind each hot word: c, t, taken
    log_total: float
    start: int           # number of START_WORD

    def of(self, block: Block) -> np.ndarray:
        middle = block.numbers[block.middle.astype(np.int64)]
        i, hot = in_sorted(self.hot, middle)
        salt = np.zeros(len(middle), np.uint64)
        by = np.where(middle[hot] == self.start, block.last[hot], block.first[hot]).astype(np.int64)
        salt[hot] = mix(block.numbers[by].astype(np.uint64)) % self.splits[i[hot]].astype(np.uint64)
        return ((mix(middle.astype(np.uint64)) + salt) % np.uint64(self.many)).astype(np.int64)


def hot_words(coded: DataFrame, tokens: int) -> DataFrame:
    """(number, n, is_start) of START_WORD and of every hot word."""
    least = max(SPLIT_TOKENS, HOT_SHARE * tokens)

    def run(batches):
        for b in batches:
            for number, n, start in zip(*(c.to_pylist() for c in b.columns)):
                number, n = np.cumsum(unpack(number, np.int64)), unpack(n, np.int64)
                own = np.arange(len(n)) == start
                take = own | (n > least)
                yield pa.RecordBatch.from_arrays([_long(number[take]), _long(n[take]), pa.array(own[take])],
                                                 names=["number", "n", "is_start"])

    return coded.select("numbers", "n", "start").mapInArrow(lean(run), "number long, n long, is_start boolean").distinct()


BLOCK_COLUMNS = ["block", "held", "lens", "seq", "numbers", "n", "start"]


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(j)[i].as_py() for j, c in enumerate(b.schema.names)}


CELL = "bucket int, block long, middle binary, last binary, n_last binary, many binary, first binary, n binary"
CELL_NAMES = ["bucket", "block", "middle", "last", "n_last", "many", "first", "n"]


def hot_cells(coded: DataFrame, sent, pair_buckets: int) -> DataFrame:
    """The pairs after hot words, counted over all training rows, as cells of every
    bucket that counts a part of them (block -1), and sums for the hot words (block -2)."""
    def run(batches):
        buckets = sent.value
        for row in _rows(batches):
            block = Block(row, buckets.hot)
            key, inv = np.unique(block.pair * buckets.many + buckets.of(block), return_inverse=True)
            pair = block.pairs[key // buckets.many]
            v, x = (pair >> SHIFT).astype(np.int64), (pair & LOW).astype(np.int64)
            cols = (block.numbers[v], block.numbers[x], block.n[x], key % buckets.many, _sums(inv, block.learned, len(key)))
            where = mix(mix(cols[0].astype(np.uint64)) + cols[1].astype(np.uint64)) % np.uint64(pair_buckets)
            order, cut = _by_bucket(where.astype(np.int64), pair_buckets)
            for i in np.flatnonzero(np.diff(cut)):
                v, x, n_x, to, n = (pa.array([pack(c[order[cut[i]:cut[i + 1]]])]) for c in cols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), _long([row["block"]]), v, x, n_x, to, pa.array([b""]), n], names=CELL_NAMES)

    def total(table):
        buckets = sent.value
        v, x, n_x, to, n = (np.concatenate([unpack(c, np.int64) for c in table.column(k).to_pylist()])
                            for k in ("middle", "last", "n_last", "many", "n"))
        ahead, a = np.unique(v, return_inverse=True)
        behind, b = np.unique(x, return_inverse=True)
        pairs, one, p = np.unique(a << 32 | b, return_index=True, return_inverse=True)
        c, of = _sums(p, n, len(pairs)), pairs >> 32
        mass = np.where(c > 0, (n_x[one] + ADD) / 10 ** buckets.log_total, 0.0)
        sums = [np.bincount(of, y, len(ahead)) for y in (c, c > 0, mass)]
        out = [(-1, -2, pack(ahead), pack(sums[0]), pack(sums[1]), b"", pack(sums[2]), b"")]
        key = np.unique(to << 32 | p)
        to, p = key >> 32, key & 0xFFFFFFFF
        cut = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
        for i, j in zip(cut, cut[1:]):
            cols = (ahead[of[p[i:j]]], behind[pairs[p[i:j]] & 0xFFFFFFFF], c[p[i:j]])
            out.append((int(to[i]), -1, *(pack(deltas(y)) for y in cols), b"", b"", b""))
        bucket, block, *packed = zip(*out)
        result = pa.table([pa.array(bucket, pa.int32()), _long(block), *(pa.array(y, pa.binary()) for y in packed)],
                          names=CELL_NAMES)
        give_back()
        return result

    return (coded.select(*BLOCK_COLUMNS).mapInArrow(lean(run), CELL).repartition(pair_buckets, "bucket")
            .groupBy("bucket").applyInArrow(total, CELL))


def hot_sums(cells: DataFrame) -> DataFrame:
    """(v, c, t, taken) of the hot words: tokens, kinds and unigram mass of what follows."""
    def run(batches):
        for b in batches:
            for cols in zip(*(b.column(k).to_pylist() for k in ("middle", "last", "n_last", "first"))):
                v, *sums = (unpack(c, kind) for c, kind in zip(cols, (np.int64, float, float, float)))
                yield pa.RecordBatch.from_arrays([_long(v), *map(pa.array, sums)], names=["v", "c", "t", "taken"])

    return (cells.filter("block = -2").mapInArrow(run, "v long, c double, t double, taken double")
            .groupBy("v").agg(*[F.sum(c).alias(c) for c in ("c", "t", "taken")]))


def gram_cells(coded: DataFrame, sent) -> DataFrame:
    """Each block's distinct trigrams with their training counts, by bucket."""
    def run(batches):
        buckets = sent.value
        for row in _rows(batches):
            block = Block(row)
            order, cut = _by_bucket(buckets.of(block), buckets.many)
            for i in np.flatnonzero(np.diff(cut)):
                own = order[cut[i]:cut[i + 1]]
                new = np.flatnonzero(np.diff(block.pair[own], prepend=-1))
                pair = block.pairs[block.pair[own[new]]]
                last = (pair & LOW).astype(np.int64)
                cell = (deltas(block.numbers[(pair >> SHIFT).astype(np.int64)]), deltas(block.numbers[last]), block.n[last],
                        np.diff(new, append=len(own)), block.numbers[block.first[own].astype(np.int64)], block.learned[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), _long([row["block"]]), *[pa.array([pack(x)]) for x in cell]],
                    names=CELL_NAMES)

    return coded.select(*BLOCK_COLUMNS).mapInArrow(lean(run), CELL)


def _backoff(left: np.ndarray, taken: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(left, LEAST) / np.maximum(1 - taken, LEAST))


def answer_cells(cells: DataFrame, sent) -> DataFrame:
    """(block, bucket, n, whole, gaps) for each cell, in its order: the counts of
    the trigrams and of their contexts; for trigrams that no training row has, the
    backoff weight of the context, the log-probability of the last word after the
    middle one (NaN where there is no such arc) and the backoff weight of the middle word."""
    def answer(table):
        buckets = sent.value
        bucket = table.column("bucket")[0].as_py()
        names = CELL_NAMES[2:]
        block = table.column("block").to_numpy()
        own, given = np.flatnonzero(block >= 0), np.flatnonzero(block < 0)
        asked = {c: [unpack(table.column(c)[int(i)].as_py(), np.int64) for i in own] for c in names}
        middle, last = (np.concatenate([np.cumsum(x) for x in asked[c]]) for c in ("middle", "last"))
        n_last, many, first, n = (np.concatenate(asked[c]) for c in names[2:])
        cuts = np.cumsum([0, *map(len, asked["n"])])
        del asked
        mid, m = np.unique(middle, return_inverse=True)
        end, e = np.unique(last, return_inverse=True)
        pairs, p = np.unique(m << 32 | e, return_inverse=True)
        seen_last = np.empty(len(pairs), np.int64)
        seen_last[p] = n_last
        _, f = np.unique(first, return_inverse=True)
        grams, g = np.unique(np.repeat(p, many) << 32 | f, return_inverse=True)
        del middle, last, n_last, first, f, m, e, p, many
        c3 = _sums(g, n, len(grams))
        pair, of = grams >> 32, pairs >> 32
        c2 = _sums(pair, c3, len(pairs))
        for i in given:
            v, x, c = (np.cumsum(unpack(table.column(k)[int(i)].as_py(), np.int64)) for k in names[:3])
            at, there = in_sorted(pairs, np.searchsorted(mid, v) << 32 | np.searchsorted(end, x))
            c2[at[there]] = c[there]
        mass = np.where(c2 > 0, (seen_last + ADD) / 10 ** buckets.log_total, 0.0)
        after = np.stack([np.bincount(of, c2, len(mid)), np.bincount(of, c2 > 0, len(mid)), np.bincount(of, mass, len(mid))])
        i, hot = in_sorted(buckets.hot, mid)
        after[:, hot] = buckets.after[:, i[hot]]
        c1, t1, taken = after
        safe = np.maximum(c1, 1)
        low1 = np.where(t1 > 0, _backoff(DISCOUNT * t1 / safe, taken), 0.0)
        context, k = np.unique((grams & 0xFFFFFFFF) << 32 | of[pair], return_inverse=True)
        whole, kinds = np.bincount(k, c3, len(context)), np.bincount(k, c3 > 0, len(context))
        low = np.bincount(k, np.where(c3 > 0, c2[pair], 0), len(context))
        own_middle = context & 0xFFFFFFFF
        bo = np.where(kinds > 0, _backoff(DISCOUNT * kinds / np.maximum(whole, 1),
                                          (low - DISCOUNT * kinds) / safe[own_middle]), 0.0)
        begin = mid[own_middle] == buckets.start  # nothing but the start stands before the start
        whole, bo = np.where(begin, c1[own_middle], whole), np.where(begin, 0.0, bo)
        with np.errstate(divide="ignore", invalid="ignore"):
            p2 = np.where(c2 > 0, np.log10((c2 - DISCOUNT) / safe[of]), np.nan)
        out = []
        for a, b in zip(cuts, cuts[1:]):
            x = g[a:b]
            none = x[c3[x] == 0]
            gaps = np.concatenate([bo[k[none]], p2[pair[none]], low1[of[pair[none]]]])
            out.append((pack(c3[x]), pack(whole[k[x]].astype(np.int64)), pack(gaps)))
        n, whole, gaps = zip(*out)
        result = pa.table({"block": _long(block[own]), "bucket": pa.array([bucket] * len(own), pa.int32()),
                           "n": pa.array(n, pa.binary()), "whole": pa.array(whole, pa.binary()), "gaps": pa.array(gaps, pa.binary())})
        give_back()
        return result

    return (cells.repartition(sent.value.many, "bucket").groupBy("bucket")
            .applyInArrow(answer, "block long, bucket int, n binary, whole binary, gaps binary"))


class Automaton:
    """The slice of the automaton that a block's texts can reach.

    State 0 is the root, 1 + w the context of word w, then come the block's
    pairs of words and last the state before a text. Arcs lie sorted by
    (state, word); ``fail`` and ``backoff`` are the failure arcs."""

    def __init__(self, block: Block, n, whole, back, p2, low, log_total: float):
        words, pairs = len(block.numbers), len(block.pairs)
        self.begin = 1 + words + pairs
        before = block.contexts()
        context = np.where(before < 0, self.begin, 1 + words + before)
        word_state, target = 1 + block.middle.astype(np.int64), 1 + words + block.pair
        none = n == 0
        long, short = np.flatnonzero(~none), np.flatnonzero(none & ~np.isnan(p2))
        state = np.concatenate([context[long], word_state[short]]).astype(np.uint64)
        gram = np.concatenate([long, short])
        key = state << SHIFT | block.last[gram]
        order = np.argsort(key)
        order = order[np.diff(key[order], prepend=np.uint64(0)) != 0]  # the root has no arc, so no key is 0
        self.keys, self.target = key[order], target[gram[order]]
        self.weight = np.concatenate([np.log10((n[long] - DISCOUNT) / whole[long]), p2[short]])[order]
        self.arcs = np.concatenate([[0], np.cumsum(np.bincount((self.keys >> SHIFT).astype(np.int64), minlength=self.begin + 1))])
        self.backoff = np.zeros(self.begin + 1)
        self.backoff[context[none]], self.backoff[word_state[none]] = back[none], low[none]
        self.fail = np.zeros(self.begin + 1, np.int64)
        self.fail[1 + words:self.begin] = 1 + (block.pairs & LOW).astype(np.int64)
        self.fail[self.begin] = 1 + int(block.start)
        self.root = np.log10(block.n + ADD) - log_total

    def arc(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each arc (state, word), and whether it is there: most states have one arc, looked at first."""
        key = state.astype(np.uint64) << SHIFT | word
        at = np.minimum(self.arcs[state], len(self.keys) - 1)
        there = self.keys[at] == key if len(self.keys) else np.zeros(len(at), bool)
        more = np.flatnonzero(~there & (self.arcs[state + 1] - self.arcs[state] > 1))
        at[more], there[more] = in_sorted(self.keys, key[more])
        return at, there

    def walk(self, seq: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Log-probabilities of texts, all read from left to right side by side."""
        order = np.argsort(-lens, kind="stable")
        begins = (np.cumsum(lens) - lens)[order]
        still = np.searchsorted(-lens[order], -np.arange(lens.max()), "left")  # texts longer than each step
        state, total = np.full(len(lens), self.begin), np.zeros(len(lens))
        for step, live in enumerate(still.tolist()):
            word = seq[begins[:live] + step]
            text = np.arange(live)
            while len(text):
                at, arc = self.arc(state[text], word[text])
                there = text[arc]
                total[there] += self.weight[at[arc]]
                state[there] = self.target[at[arc]]
                text = text[~arc]
                root = text[state[text] == 0]
                total[root] += self.root[word[root].astype(np.int64)]
                text = text[state[text] != 0]
                state[root] = 1 + word[root].astype(np.int64)
                total[text] += self.backoff[state[text]]
                state[text] = self.fail[state[text]]
        out = np.empty(len(lens))
        out[order] = total
        return out


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    spark = docs.sparkSession
    src = docs.select(docs[text_col].alias("text"), docs[id_col].alias("id"),
                      (~training(docs[id_col])).alias("held_out"), F.monotonically_increasing_id().alias("rid"))
    blocks = materialize(text_blocks(src), "lm-blocks")
    size = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("vocab", "tokens")],
                      F.count(F.lit(1)).alias("many")).first()
    tokens, partitions = int(size["tokens"]), int(max(8, size["many"]))
    coded = materialize(number_words(blocks, int(max(8, size["vocab"] // BUCKET_WORDS)), partitions), "lm-coded")
    distinct = (coded.select(F.explode(F.arrays_zip("parts", "distinct")).alias("x")).select("x.*").distinct()
                .agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0])
    log_total = float(np.log10(tokens + ADD * (int(distinct) + 1)))
    hot = hot_words(coded, tokens).toPandas()  # the start and at most 1 / HOT_SHARE words
    start = hot["number"][hot["is_start"]]
    hot = hot[hot["n"] > max(SPLIT_TOKENS, HOT_SHARE * tokens)].sort_values("number")
    splits = -(-hot["n"].to_numpy(np.int64) // SPLIT_TOKENS)
    buckets = Buckets(int(max(8, tokens // BUCKET_GRAMS)), hot["number"].to_numpy(np.int64), splits,
                      np.zeros((3, len(hot))), log_total, int(start.iloc[0]) if len(start) else -1)
    sent = spark.sparkContext.broadcast(buckets)
    cells = gram_cells(coded, sent)
    if len(hot):
        parts = materialize(hot_cells(coded, sent, int(max(8, hot["n"].sum() // BUCKET_GRAMS))), "lm-hot")
        after = hot_sums(parts).toPandas().set_index("v")  # a row a hot word
        after = after.reindex(buckets.hot, fill_value=0)  # the end is hot, but before nothing
        sent = spark.sparkContext.broadcast(replace(buckets, after=after.to_numpy(float).T.copy()))
        cells = cells.unionByName(parts.filter("block = -1"))
    answers = answer_cells(cells, sent)

    def score(coded, answers):
        ids = coded.column("ids").combine_chunks().flatten()
        buckets = sent.value
        block = Block({c: coded.column(c)[0].as_py() for c in BLOCK_COLUMNS})
        order, cut = _by_bucket(buckets.of(block), buckets.many)
        n, whole = np.zeros(len(order), np.int64), np.ones(len(order), np.int64)
        gaps = np.zeros((3, len(order)))
        for i, *cell in zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "whole", "gaps"))):
            own = order[cut[i]:cut[i + 1]]
            n[own], whole[own] = (unpack(x, np.int64) for x in cell[:2])
            gaps[:, own[n[own] == 0]] = unpack(cell[2], float).reshape(3, -1)
        model = Automaton(block, n, whole, *gaps, buckets.log_total)
        del order, n, whole, gaps
        text = np.repeat(np.arange(len(block.lens)), block.lens)
        at = block.seq.astype(np.int64)
        out = pa.table({id_col: ids, "held_out": pa.array(block.held), "n_tokens": _long(block.lens),
                        "n_known": _long(np.bincount(text, block.n[at] > 0, len(block.lens))),
                        "train_tokens": _long(np.full(len(block.lens), tokens)),
                        "base_score": pa.array(np.bincount(text, model.root[at], len(block.lens))),
                        "score": pa.array(model.walk(block.seq, block.lens))})
        give_back()
        return out

    kind = src.schema["id"].dataType.simpleString()
    sent_blocks = coded.select("ids", *BLOCK_COLUMNS).repartition(partitions, "block")
    return sent_blocks.groupBy("block").cogroup(answers.repartition(partitions, "block").groupBy("block")).applyInArrow(
        score, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
