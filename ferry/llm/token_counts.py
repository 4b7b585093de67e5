"""Token counts at every prefix by dynamic programming (operator 11).

A tokenizer of the word-end kind cuts a lower-cased text into words and merges
the bytes of each; the last byte of a word carries an end mark. Cutting a text
short cuts at most one word, and that word then ends earlier, so the count at
a prefix is the count of the whole words before it and that of the part word.

Part words are counted for all their ends at once. ``last[k]`` is the token
that the encoding of the first k bytes ends with, without an end mark. Of the
vocabulary's tokens that match up to k (walked in a trie), one alone can
follow the encoding of the bytes before it: the merges that the two tokens
were made of show whether a merge across their border would have come first.
So ``count[k] = count[k - len] + 1``, and the same step with the tokens that
carry an end mark gives the count at that prefix. The program runs once for
each distinct word of a task, for all its words at the same depth together.

Prefixes are those of the text in normal form C and lower case, in bytes, cut
between characters. Counts may fall as a prefix grows; the prefix that fits a
budget is the longest one whose count does.

Rows: null text counts as empty (no bytes, no tokens); a special token's text
is that token, and its own prefixes are plain text; long texts are taken in
parts cut before a space; repeated rows are counted each; ids may be null or
repeat; other columns are passed by; an empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, normalizers

from ferry.llm.textbatch import LOWER, in_sorted, lean, ragged, span_hashes, utf8

SPACE_, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# The public pattern and its contractions.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Bytes of text that are looked at together, and so the longest part of a text with spaces.
PART_BYTES = 1 << 20
#: Distinct words kept between the parts of a task.
CACHE_WORDS = 1_000_000
#: Words beyond this length go one by one.
LONG_WORD = 64
NEVER = 1 << 30


def byte_signs() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones stand for themselves, the others follow U+0100 in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def char_classes(cut) -> np.ndarray:
    """Class of every code point, as the library's own cutter sees it: it cuts
    the row of all characters into runs, and one character tells a run's class."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = np.full(0x110000, SPACE_, np.uint8)  # what lies in no run
    for _, (a, b) in cut.pre_tokenize_str(every):
        c = every[a]
        kind = LETTER if len(cut.pre_tokenize_str("x" + c)) == 1 else \
            NUMBER if len(cut.pre_tokenize_str(c + c)) == 2 else OTHER
        out[ord(c):ord(every[b - 1]) + 1] = kind
    return out


class PrefixCounter:
    """The counts of one tokenizer file of the word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (model["type"], model["end_of_word_suffix"], steps) != ("BPE", WORD_END, ["NFC", "Replace", "Lowercase"]) \
                or split["pattern"].get("Regex") != PATTERN or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only lower-case byte-level files with word ends are read here")
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError("only plain special tokens are read here")
        self.special = {a["content"].encode(): a["id"] for a in spec["added_tokens"]}
        self._merges(model)
        self._trie()
        self.classes = char_classes(Tokenizer.from_file(path).pre_tokenizer)
        self.form = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.lower2 = self._two_byte_lower()
        self.known: dict[tuple[int, int], bool] = {}
        self.cut_special: dict[bytes, np.ndarray] = {}
        self.reset()

    # ------------------------------------------------------------- tables
    def _merges(self, model: dict) -> None:
        vocab, signs = model["vocab"], byte_signs()
        size = max(vocab.values()) + 1
        if size > 1 << 16:
            raise ValueError("vocabularies of up to 65,536 ids are read here")
        text: dict[int, bytes] = {}
        self.ends = np.zeros(size, bool)
        for b, c in enumerate(signs):
            text[vocab[c]] = text[vocab[c + WORD_END]] = bytes([b])
            self.ends[vocab[c + WORD_END]] = True
        self.rank = np.full(size, -1, np.int32)  # of the merge that makes a token; -1: a byte
        self.left, self.right = np.zeros(size, np.int32), np.zeros(size, np.int32)
        keys, ranks = [], []
        for r, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)]
            if made in text or r <= max(self.rank[a], self.rank[b]):
                raise ValueError("each token must have one merge, later than those of its parts")
            text[made], self.ends[made] = text[a] + text[b], self.ends[b]
            self.rank[made], self.left[made], self.right[made] = r, a, b
            keys.append(a << 16 | b)
            ranks.append(r)
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_ranks = np.array(ranks, np.int32)[order]
        self.text = text

    def _trie(self) -> None:
        """Tokens that their own text is encoded as, in a trie whose nodes are numbered by (parent, byte)."""
        ids = np.array(sorted(self.text, key=lambda t: self.rank[t]), np.int64)
        made = ids[self.rank[ids] >= 0]
        sound = np.zeros(len(self.rank), bool)
        sound[ids[self.rank[ids] < 0]] = True
        alone = np.zeros(len(self.rank), bool)
        alone[made] = self.follows(self.left[made], self.right[made], self.rank[made])
        for t in made.tolist():  # parts come before
            sound[t] = alone[t] and sound[self.left[t]] and sound[self.right[t]]
        level, keys, self.plain, self.ended = {b"": 0}, [], [-1], [-1]
        by_text: dict[bytes, list[int]] = {}
        for t in ids[sound[ids]].tolist():
            by_text.setdefault(self.text[t], []).append(t)
        prefixes = sorted({s[:k] for s in by_text for k in range(1, len(s) + 1)}, key=lambda s: (len(s), s))
        depth, here = 0, {}
        for s in prefixes:  # sorted: parents have ascending numbers
            if len(s) != depth:
                depth, level, here = len(s), here or level, {}
            keys.append(level[s[:-1]] << 8 | s[-1])
            here[s] = len(keys)
            own = by_text.get(s, ())
            self.plain.append(next((t for t in own if not self.ends[t]), -1))
            self.ended.append(next((t for t in own if self.ends[t]), -1))
        self.trie = np.array(keys, np.int64)
        self.children = {k: i + 1 for i, k in enumerate(keys)}
        self.plain, self.ended = np.array(self.plain, np.int32), np.array(self.ended, np.int32)
        self.pair_rank = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist()))

    def _two_byte_lower(self) -> np.ndarray:
        """Lower case of U+0080 to U+02FF as code points; 0 where it has another length."""
        out = np.zeros(0x300, np.int32)
        for c in range(0x80, 0x300):
            low = self.form.normalize_str(chr(c))
            out[c] = ord(low) if len(low) == 1 and 0x80 <= ord(low) < 0x800 else 0
        return out

    def reset(self) -> None:
        self.words = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    # ------------------------------------------------------------- program
    def follows(self, a: np.ndarray, b: np.ndarray, limit) -> np.ndarray:
        """Whether b can stand behind a: no merge across their border, of a
        rank below ``limit``, comes before those that made a and b. Walks both
        back, the one made later first."""
        a, b = np.asarray(a, np.int64).copy(), np.asarray(b, np.int64).copy()
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape).copy()
        out, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            i, there = in_sorted(self.pair_keys, a << 16 | b)
            bad = there & (self.pair_ranks[i] < limit)
            out[open_[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            left = ra > rb
            go = ~bad & ((ra >= 0) | (rb >= 0))
            limit = np.where(left, ra, rb + 1)[go]  # of equal pairs the left one merges first
            a, b = np.where(left, self.right[a], a)[go], np.where(left, b, self.left[b])[go]
            open_ = open_[go]
        return out

    def _one_follows(self, a: int, b: int) -> bool:
        got = self.known.get((a, b))
        if got is None:
            got = self.known[a, b] = bool(self.follows(np.array([a]), np.array([b]), NEVER)[0])
        return got

    def _matches(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, node) of every token text; ``room``: bytes to the word's end from each byte."""
        at, node, out, n = np.arange(len(data)), np.zeros(len(data), np.int64), [], 0
        while len(at):
            i, there = in_sorted(self.trie, node << 8 | data[at + n])
            at, node, n = at[there], i[there] + 1, n + 1
            some = (self.plain[node] >= 0) | (self.ended[node] >= 0)
            out.append((at[some], np.full(int(some.sum()), n), node[some]))
            more = room[at] > n
            at, node = at[more], node[more]
        return tuple(np.concatenate(x) for x in zip(*out))

    def count_words(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Counts at every end of the words that lie end to end in ``data``."""
        n = len(data)
        ends = np.cumsum(lens)
        begin = np.repeat(ends - lens, lens)
        out, count = np.zeros(n, np.int32), np.zeros(n + 1, np.int32)
        last = np.full(n + 1, -1, np.int32)  # at a word's first byte: nothing before
        if n == 0:
            return out
        start, length, node = self._matches(data, np.repeat(ends, lens) - np.arange(n))
        stop = start + length - 1  # the byte a token ends with
        depth = stop - begin[stop]
        order = np.argsort(depth, kind="stable")
        start, stop, node, depth = start[order], stop[order], node[order], depth[order]
        cuts = np.searchsorted(depth, np.arange(int(depth[-1]) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            s, e, v = start[lo:hi], stop[lo:hi], node[lo:hi]
            fresh = s == begin[s]
            # state of a byte: the encoding of its word's bytes up to it; kept one place on
            before, so_far = np.where(fresh, -1, last[s]), np.where(fresh, 0, count[s])
            for table, ended in ((self.plain, False), (self.ended, True)):
                token = table[v]
                ok = token >= 0
                test = np.flatnonzero(ok & ~fresh)
                ok[test] = self.follows(before[test], token[test], NEVER)
                if ended:
                    out[e[ok]] = so_far[ok] + 1
                else:
                    last[e[ok] + 1], count[e[ok] + 1] = token[ok], so_far[ok] + 1
        return out

    def count_long(self, word: bytes) -> np.ndarray:
        """``count_words`` for one long word, a byte at a time."""
        n = len(word)
        out, count, last = np.zeros(n, np.int32), [0] * (n + 1), [-1] * (n + 1)
        for s in range(n):  # all that ends at s is settled: hand on from here
            node, before = 0, last[s]
            for e in range(s, n):
                node = self.children.get(node << 8 | word[e])
                if node is None:
                    break
                t = int(self.plain[node])
                if t >= 0 and (s == 0 or self._one_follows(before, t)):
                    last[e + 1], count[e + 1] = t, count[s] + 1
                t = int(self.ended[node])
                if t >= 0 and (s == 0 or self._one_follows(before, t)):
                    out[e] = count[s] + 1
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        return out

    # -------------------------------------------------------------- cutting
    def _plain_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows whose normal form keeps every byte's place: ASCII, most of
        U+0080 to U+02FF, and typographic signs."""
        pad = np.concatenate([data, np.zeros(2, np.uint8)])
        lead = np.flatnonzero(data >= 0xC2)
        b0, b1, b2 = pad[lead], pad[lead + 1], pad[lead + 2]
        two = (b0 < 0xCC) & (self.lower2[np.where(b0 < 0xCC, (b0.astype(np.int32) & 0x1F) << 6 | b1 & 0x3F, 0)] > 0)
        sign = (b0 == 0xE2) & (b1 == 0x80) & (((b2 >= 0x90) & (b2 <= 0xA7)) | (b2 >= 0xB0))
        odd = lead[~(two | sign)]
        plain = np.ones(len(offsets) - 1, bool)
        plain[np.searchsorted(offsets, odd, "right") - 1] = False
        return plain

    def _lowered(self, data: np.ndarray) -> np.ndarray:
        out = LOWER[data]
        lead = np.flatnonzero((data >= 0xC2) & (data < 0xCC))
        code = self.lower2[(data[lead].astype(np.int32) & 0x1F) << 6 | data[lead + 1] & 0x3F]
        changed = code > 0
        lead, code = lead[changed], code[changed]
        out[lead], out[lead + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F
        return out

    def normal(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Bytes and offsets in normal form and lower case, and the special
        tokens (start, end, id): their texts stay as they are."""
        def specials(raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
            found = []
            for t, i in self.special.items():
                at = raw.find(t)
                while at >= 0:
                    row = int(np.searchsorted(offsets, at, "right")) - 1
                    inside = at + len(t) <= offsets[row + 1]
                    if inside:
                        found.append((at, at + len(t), i))
                    at = raw.find(t, at + (len(t) if inside else 1))
            return sorted(found)

        plain = self._plain_rows(data, offsets)
        found = specials(data.tobytes(), offsets)
        if plain.all():
            return self._lowered(data), offsets, found
        rows, marks, size = [], [], 0
        for r, easy in enumerate(plain.tolist()):
            own = data[offsets[r]:offsets[r + 1]]
            if easy:
                marks += [(a - offsets[r] + size, b - offsets[r] + size, i) for a, b, i in found
                          if offsets[r] <= a < offsets[r + 1]]
                rows.append(self._lowered(own).tobytes())
            else:
                parts, at = [], 0
                for a, b, i in [*specials(own.tobytes(), np.array([0, len(own)])), (len(own), len(own), -1)]:
                    parts.append(self.form.normalize_str(own[at:a].tobytes().decode()).encode())
                    if i >= 0:
                        here = size + sum(map(len, parts))
                        marks.append((here, here + b - a, i))
                        parts.append(own[a:b].tobytes())
                    at = b
                rows.append(b"".join(parts))
            size += len(rows[-1])
        out = np.frombuffer(b"".join(rows), np.uint8)
        return out, np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64), marks

    def _runs(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all words and runs of white space, and each one's class;
        a run never crosses an edge."""
        n = len(data)
        head = (data & 0xC0) != 0x80
        at = np.flatnonzero(head)
        pad = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
        b0, b1, b2, b3 = pad[at], pad[at + 1] & 0x3F, pad[at + 2] & 0x3F, pad[at + 3] & 0x3F
        code = np.select([b0 < 0x80, b0 < 0xE0, b0 < 0xF0],
                         [b0, (b0 & 0x1F) << 6 | b1, (b0 & 0xF) << 12 | b1 << 6 | b2],
                         (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3)
        kind = self.classes[code]
        fresh = np.zeros(n + 1, bool)
        fresh[edges] = True
        fresh[n] = True
        start = fresh[at].copy()
        start[1:] |= kind[1:] != kind[:-1]
        start |= kind == NUMBER
        quote = np.flatnonzero(start & (code == 0x27))  # a contraction starts a run of signs
        if len(quote):
            byte = at[quote]
            stop = np.concatenate([fresh[1:], np.ones(3, bool)])  # an edge follows this byte
            for text in CONTRACTIONS:  # ASCII: bytes are characters
                hit = np.ones(len(quote), bool)
                for j, b in enumerate(text):
                    hit &= (pad[np.minimum(byte + 1 + j, n)] == b) & ~stop[byte + j]
                q = quote[hit]
                start[q + 1] = False
                after = q + 1 + len(text)
                start[after[after < len(at)]] = True
        own = np.flatnonzero(start)
        return at[own], kind[own]

    # --------------------------------------------------------------- counts
    def prefix_counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts, bytes, offsets): the normal form of the rows, and behind
        each of its bytes the count of the row's tokens up to there."""
        data, offsets, special = self.normal(data, offsets)
        if len(data) == 0:
            return np.zeros(0, np.int64), data, offsets
        marks = np.array([x for a, b, _ in special for x in (a, b)], np.int64)
        starts, kind = self._runs(data, np.unique(np.concatenate([offsets[offsets < len(data)], marks[marks < len(data)]])))
        ends = np.append(starts[1:], len(data))
        if special:  # what lies in a special token is one run
            first = np.searchsorted(starts, [a for a, _, _ in special])
            keep = np.ones(len(starts), bool)
            for (a, b, _), f in zip(special, first.tolist()):
                keep[f + 1:int(np.searchsorted(starts, b))] = False
            starts, kind = starts[keep], kind[keep]
            ends = np.append(starts[1:], len(data))
        lens = ends - starts
        word = kind != SPACE_
        is_special, _ = in_sorted(np.array([a for a, _, _ in special], np.int64), starts)
        at_special = np.zeros(len(starts), bool)
        if special:
            at_special = starts == np.array([a for a, _, _ in special])[is_special]
        word &= ~at_special
        inner = np.zeros(len(data), np.int64)
        inner[ragged(starts[word], lens[word])] = self._looked_up(data, starts[word], ends[word])
        whole = inner[ends - 1]
        whole[at_special] = 1
        base = np.cumsum(whole) - whole
        row = np.searchsorted(offsets, starts, "right") - 1
        first = np.searchsorted(starts, offsets[:-1])
        base -= np.append(base, 0)[np.minimum(first, len(base))][row]
        counts = np.repeat(base, lens) + inner
        for i in np.flatnonzero(at_special).tolist():
            a, b = int(starts[i]), int(ends[i])
            joined = i > 0 and kind[i - 1] == OTHER and not at_special[i - 1] and a not in offsets[row[i]:row[i] + 1]
            begin = int(starts[i - 1]) if joined and not self._is_contraction(data[starts[i - 1]:a].tobytes()) else a
            text = data[begin:b - 1].tobytes()
            if text not in self.cut_special:
                if len(self.cut_special) > CACHE_WORDS // 100:
                    self.cut_special = {}
                self.cut_special[text] = self._plain_counts(np.frombuffer(text, np.uint8))
            counts[a:b - 1] = self.cut_special[text][a - begin:] + (base[i - 1] if begin < a else base[i])
            counts[b - 1] = base[i] + 1
        return counts, data, offsets

    @staticmethod
    def _is_contraction(text: bytes) -> bool:
        return text[:1] == b"'" and text[1:] in CONTRACTIONS

    def _plain_counts(self, data: np.ndarray) -> np.ndarray:
        """Counts behind each byte of one text in which nothing is special."""
        starts, kind = self._runs(data, np.zeros(1, np.int64))
        ends = np.append(starts[1:], len(data))
        word = kind != SPACE_
        inner = np.zeros(len(data), np.int64)
        inner[ragged(starts[word], (ends - starts)[word])] = self._looked_up(data, starts[word], ends[word])
        whole = inner[ends - 1]
        return np.repeat(np.cumsum(whole) - whole, ends - starts) + inner

    def _looked_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The counts of all words end to end; new words are counted first."""
        h = span_hashes(data, starts, ends)
        code, uniq = pd.factorize(h)
        where = np.empty(len(uniq), np.int64)
        where[code] = np.arange(len(h))
        if len(self.words) > CACHE_WORDS:
            self.reset()
        at, there = in_sorted(self.words, uniq)
        if not there.all():
            new = where[~there]
            lens = ends[new] - starts[new]
            counts = np.zeros(int(lens.sum()), np.int32)
            first = np.cumsum(lens) - lens
            short = lens <= LONG_WORD
            counts[ragged(first[short], lens[short])] = self.count_words(data[ragged(starts[new][short], lens[short])], lens[short])
            for i in np.flatnonzero(~short).tolist():
                counts[first[i]:first[i] + lens[i]] = self.count_long(data[starts[new][i]:ends[new][i]].tobytes())
            for i in np.flatnonzero((lens == 3) & (data[starts[new]] == 0x27)).tolist():
                if self._is_contraction(data[starts[new][i]:ends[new][i]].tobytes()):
                    counts[first[i] + 1] = 2  # cut inside: a sign and a letter
            words = np.concatenate([self.words, uniq[~there]])
            begin = np.concatenate([self.first, len(self.store) + first])
            size = np.concatenate([self.size, lens])
            order = np.argsort(words, kind="stable")
            self.words, self.first, self.size = words[order], begin[order], size[order]
            self.store = np.concatenate([self.store, counts])
            at, _ = in_sorted(self.words, uniq)
        return self.store[ragged(self.first[at][code], self.size[at][code])]


_LOADED: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per file and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PrefixCounter(path)
    return _LOADED[path]


def parts(data: np.ndarray, offsets: np.ndarray, limit: int = PART_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Rows cut before spaces into parts of about ``limit`` bytes: all bounds, and each part's row."""
    long = np.flatnonzero(np.diff(offsets) > limit)
    extra = []
    for r in long.tolist():
        spaces = np.flatnonzero(data[offsets[r]:offsets[r + 1]] == 0x20) + offsets[r]
        at = offsets[r]
        while at + limit < offsets[r + 1]:
            i = int(np.searchsorted(spaces, at + limit, "right")) - 1
            if i < 0 or spaces[i] <= at:
                i += 1  # no space within the limit: the next one
            if i >= len(spaces):
                break
            at = spaces[i]
            extra.append(at)
    bounds = np.sort(np.concatenate([offsets, np.array(extra, np.int64)]))
    row = np.searchsorted(offsets[1:], bounds[:-1], "right")
    empty = np.diff(offsets) == 0
    if empty.any():  # an empty row is a part of its own
        order = np.concatenate([np.repeat(np.arange(len(offsets) - 1), 1)[empty], row[np.diff(bounds) > 0]])
        size = np.concatenate([np.zeros(int(empty.sum()), np.int64), np.diff(bounds)[np.diff(bounds) > 0]])
        by = np.argsort(order, kind="stable")
        row, bounds = order[by], np.concatenate([[0], np.cumsum(size[by])])
    return bounds.astype(np.int64), row.astype(np.int64)


def _counted(path: str, column):
    """For groups of parts of a batch: (rows, counts, bytes, offsets)."""
    from ferry.llm.textbatch import chunks
    data, off = utf8(column)
    bounds, row = parts(data, off)
    for lo, hi in chunks(bounds, PART_BYTES):
        counts, form, form_off = counter(path).prefix_counts(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
        yield row[lo:hi], counts, form, form_off


def _sides(counts: np.ndarray, form: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each part, and whether a character ends behind each byte."""
    total = np.append(counts, 0)[np.maximum(off[1:] - 1, 0)]
    total[off[1:] == off[:-1]] = 0
    whole = np.ones(len(form), bool)
    whole[:-1] = (form[1:] & 0xC0) != 0x80
    return total, whole


def count_documents(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit, fitting_bytes)`` of every row;
    ``fitting_bytes``: the longest prefix of at most ``limit`` tokens."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
                           T.StructField("fitting_bytes", T.LongType())])

    def run(batches):
        for b in batches:
            n = b.num_rows
            tokens, size, fit = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for row, counts, form, off in _counted(path, b.column(1)):
                total, whole = _sides(counts, form, off)
                # parts of a row follow each other: what came before it in this group, and in earlier ones
                before, bytes_before = np.cumsum(total) - total, off[:-1].copy()
                first = np.searchsorted(row, row)
                before += tokens[row] - before[first]
                bytes_before += size[row] - bytes_before[first]
                lens = np.diff(off)
                ok = np.flatnonzero(whole & (counts + np.repeat(before, lens) <= limit))
                i = np.searchsorted(ok, off[1:], "left") - 1
                some = (i >= 0) & (np.append(ok, -1)[i] >= off[:-1])
                reach = np.where(some, np.append(ok, -1)[i] + 1 - off[:-1] + bytes_before, 0)
                np.maximum.at(fit, row, reach)
                np.add.at(tokens, row, total)
                np.add.at(size, row, lens)
            _, raw = utf8(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(raw)), pa.array(tokens), pa.array(tokens > limit), pa.array(fit)],
                names=schema.names)

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), schema)


def prefix_store(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, first_byte, first_token, counts)``: for each part of a row its
    place, the tokens before it, and behind each byte the tokens of the part
    up to there as little-endian 32-bit integers, -1 inside a character. An
    empty text is one empty part."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            tokens, size = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for row, counts, form, off in _counted(path, b.column(1)):
                total, whole = _sides(counts, form, off)
                cells = np.where(whole, counts, -1).astype("<i4")
                place, before = [], []
                for r, t, n in zip(row.tolist(), total.tolist(), np.diff(off).tolist()):
                    place.append(int(size[r]))
                    before.append(int(tokens[r]))
                    tokens[r] += t
                    size[r] += n
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(place, pa.int64()), pa.array(before, pa.int64()),
                     pa.array([cells[x:y].tobytes() for x, y in zip(off[:-1], off[1:])], pa.binary())],
                    names=["id", "first_byte", "first_token", "counts"])

    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(lean(run), f"id {kind}, first_byte long, first_token long, counts binary")
            .withColumnRenamed("id", id_col))


def answer(store: DataFrame, questions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Answers from the stored counts, without the texts. ``questions``:
    ``(id, question, budget, at_byte)``; a budget asks for the longest prefix
    of at most so many tokens, ``at_byte`` for the tokens of that prefix.
    Gives ``(id, question, fitting_bytes, tokens)``: null where not asked,
    and tokens also where the prefix ends inside a character or beyond the
    text. An id that the store doesn't have gets no answer."""
    asked = questions.select(F.col(id_col).alias("id"), "question", F.col("budget").cast("long").alias("budget"),
                             F.col("at_byte").cast("long").alias("at_byte"))
    both = store.withColumnRenamed(id_col, "id").join(asked, "id")

    def run(batches):
        for b in batches:
            fits, tokens = [], []
            for first, before, cells, budget, at in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 5, 6))):
                counts = np.frombuffer(cells, "<i4")
                ok = np.flatnonzero((counts >= 0) & (counts + before <= budget)) if budget is not None else ()
                fits.append(None if budget is None or budget < 0 else first + int(ok[-1]) + 1 if len(ok) else 0)
                inside = at is not None and first < at <= first + len(counts) and counts[at - first - 1] >= 0
                tokens.append(before + int(counts[at - first - 1]) if inside else 0 if at == 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(4), pa.array(fits, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["id", "question", "fitting_bytes", "tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    return (both.select("id", "first_byte", "first_token", "counts", "question", "budget", "at_byte")
            .mapInArrow(run, f"id {kinds['id']}, question {kinds['question']}, fitting_bytes long, tokens long")
            .groupBy("id", "question").agg(F.max("fitting_bytes").alias("fitting_bytes"), F.max("tokens").alias("tokens"))
            .withColumnRenamed("id", id_col))
