"""BPE encoding and decoding by a pair occurrence index (operator 2).

Texts are cut into pieces with the byte-level pattern; the distinct pieces of
a partition are laid out in one linked array. An index maps every adjacent
pair that has a merge rank to all its positions. Ranks are applied in
ascending order: all occurrences of the pair merge at once, and only the
lists of the pairs that this creates are updated. A pair made by a merge
always has a higher rank than the merge, so one ascending pass gives what
merging the best pair of each word again and again gives.

Rows: null text counts as empty (no ids, empty decode); any other column,
null or not, is passed by; repeated rows are encoded each; an empty table
gives an empty result. The text of an added token becomes that token's id.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ferry.llm.textbatch import chunks, in_sorted, ragged, span_hashes, utf8

# Fixed value: the public byte-level pattern's contractions.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
#: Bytes of text whose distinct pieces are encoded together.
PARTITION_BYTES = 8 << 20
#: Distinct pieces kept between partitions of a task.
CACHE_PIECES = 2_000_000
SPACE_, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _classes() -> np.ndarray:
    import regex
    kinds = [regex.compile(p) for p in (r"\s", r"\p{L}", r"\p{N}")]
    return np.array([next((k for k, p in enumerate(kinds) if p.match(chr(c))), OTHER)
                     for c in range(0x500)], np.uint8)


class ByteBPE:
    """Encoder and decoder of one tokenizer file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (pre.get("type"), model.get("type"), spec.get("normalizer")) != ("ByteLevel", "BPE", None) \
                or pre.get("add_prefix_space") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are read here")
        self.path, self._slow = path, None
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        size = max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        if size > 1 << 16:
            raise ValueError("vocabularies of up to 65,536 ids are read here")
        texts: list[bytes] = [b""] * size
        for t, i in vocab.items():
            texts[i] = bytes(alphabet[c] for c in t)
        self.added = {a["content"].encode(): a["id"] for a in spec["added_tokens"]}
        for t, i in self.added.items():
            texts[i] = t
        self.vocab_lens = np.array([len(t) for t in texts], np.int64)
        self.vocab_starts = np.cumsum(self.vocab_lens) - self.vocab_lens
        self.vocab_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_ids[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self.left.astype(np.int64) << 16 | self.right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        # 16-bit ranks sort by radix
        self.rank_of = order.astype(np.uint16 if len(order) <= 1 << 16 else np.int32)
        self.classes = _classes()
        self.reset()

    # ------------------------------------------------------------ cutting
    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows with characters whose class this file doesn't state."""
        lead = data >= 0xD4
        at = np.flatnonzero(lead)
        if len(at):
            pad = np.concatenate([data, np.zeros(2, np.uint8)])
            b1, b2 = pad[at + 1], pad[at + 2]
            plain = (pad[at] == 0xE2) & (b1 == 0x80) & (((b2 >= 0x90) & (b2 <= 0xA7)) | (b2 >= 0xB0))
            at = at[~plain]
        odd = np.zeros(len(offsets) - 1, bool)
        if len(at):
            odd[np.searchsorted(offsets, at, "right") - 1] = True
        return odd

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces of texts without odd characters."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int64)
        kind = np.full(n, OTHER, np.uint8)
        ascii_ = data < 0x80
        kind[ascii_] = self.classes[data[ascii_]]
        lead2 = np.flatnonzero((data >= 0xC2) & (data < 0xD4))
        if len(lead2):
            code = (data[lead2].astype(np.int32) & 0x1F) << 6 | data[lead2 + 1] & 0x3F
            kind[lead2] = kind[lead2 + 1] = self.classes[code]
        cont = (data & 0xC0) == 0x80
        prev = np.empty(n, np.uint8)
        prev[0] = 255
        prev[1:] = kind[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        fresh = np.zeros(n + 1, bool)
        fresh[first] = True
        fresh[n] = True
        start = (kind != prev) & ~cont
        start |= fresh[:-1]
        blank = kind == SPACE_
        # A run of white space before a solid character gives its last character away.
        solid_after = np.flatnonzero(start & ~blank & ~fresh[:-1] & (prev == SPACE_))
        if len(solid_after):
            last = solid_after - 1
            while (c := cont[last]).any():
                last = last - c
            start[last] = True
            joined = data[last] == 0x20
            start[solid_after[joined]] = False
            # other white space stays a piece of its own
        quote = np.flatnonzero(start & (data == 0x27))
        if len(quote):
            pad = np.concatenate([data, np.zeros(3, np.uint8)])
            stop = np.concatenate([fresh[1:], np.ones(3, bool)])  # a text ends after this byte
            for text in CONTRACTIONS:
                k = len(text)
                hit = np.ones(len(quote), bool)
                for j, b in enumerate(text):
                    hit &= (pad[quote + 1 + j] == b) & ~stop[quote + j]
                q = quote[hit]
                if len(q):
                    start[q + 1] = False
                    after = q + 1 + k
                    inside = after < n
                    start[after[inside]] = True
        return np.flatnonzero(start)

    def _cut_slow(self, text: bytes) -> list[int]:
        """Piece starts by the library's own cutter, for odd characters."""
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self.path).pre_tokenizer
        s = text.decode("utf-8")
        size = np.cumsum([0] + [len(c.encode()) for c in s])
        return sorted({int(size[a]) for _, (a, b) in self._slow.pre_tokenize_str(s) if b > a})

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts cut at added tokens: offsets, and the id (-1: text)."""
        raw, cuts = data.tobytes(), []
        for t, i in self.added.items():
            at = raw.find(t)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(t) <= offsets[row + 1]:
                    cuts.append((at, at + len(t), i))
                    at = raw.find(t, at + len(t))
                else:  # spans two rows
                    at = raw.find(t, at + 1)
        if not cuts:
            return offsets, np.full(len(offsets) - 1, -1)
        ids = {a: i for a, _, i in cuts}
        marks = np.unique(np.concatenate([offsets, np.array([c[:2] for c in cuts]).ravel()]))
        return marks, np.array([ids.get(int(a), -1) for a in marks[:-1]])

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of every piece of a batch of texts."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in chunks(offsets):
            base = offsets[lo]
            d, o = data[base:offsets[hi]], offsets[lo:hi + 1] - base
            if len(d) == 0:
                continue
            seg, special = self._segments(d, o)
            starts = self._cut(d, seg)
            odd = self._odd(d, seg)
            if odd.any():
                row = np.searchsorted(seg, starts, "right") - 1
                slow = [np.array(self._cut_slow(d[seg[r]:seg[r + 1]].tobytes()), np.int64) + seg[r]
                        for r in np.flatnonzero(odd)]
                starts = np.sort(np.concatenate([starts[~odd[row]], *slow]))
            if (special >= 0).any():
                row = np.searchsorted(seg, starts, "right") - 1
                starts = np.sort(np.concatenate([starts[special[row] < 0], seg[:-1][special >= 0]]))
            ends = np.append(starts[1:], len(d))
            h = span_hashes(d, starts, ends)
            if (special >= 0).any():
                at, there = in_sorted(seg[:-1][special >= 0], starts)
                h[there] = special[special >= 0][at[there]].astype(np.uint64)  # ids below 65,536
            out.append((starts + base, ends + base, h))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out))

    # ----------------------------------------------------------- merging
    def merge(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces laid end to end, and the number of ids by piece."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(lens), np.int64)
        tok = self.byte_ids[data].copy()
        nxt = np.arange(1, n + 1, dtype=np.int64)
        prv = np.arange(-1, n - 1, dtype=np.int64)
        ends = np.cumsum(lens)
        nxt[ends - 1] = -1
        prv[ends - lens] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            """Index the pairs that start at these positions."""
            at = at[nxt[at] >= 0]
            if not len(at):
                return
            i, there = in_sorted(self.keys, tok[at].astype(np.int64) << 16 | tok[nxt[at]])
            at, ranks = at[there], self.rank_of[i[there]]
            if len(at) == 1:
                groups = [(int(ranks[0]), at)]
            else:
                order = np.argsort(ranks, kind="stable")
                at, ranks = at[order], ranks[order]
                cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                groups = zip(ranks[np.append(0, cut)].tolist(), np.split(at, cut)) if len(at) else ()
            for r, p in groups:
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        add(np.arange(n))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            at = at[(tok[at] == a) & (nxt[at] >= 0)]
            at = at[tok[nxt[at]] == b]
            if not len(at):
                continue
            if a == b:  # runs: from the left, without overlap
                at, free, keep = np.sort(at), -1, []
                for p in at.tolist():
                    if p != free:
                        keep.append(p)
                        free = int(nxt[p])
                at = np.array(keep, np.int64)
            gone = nxt[at]
            after = nxt[gone]
            tok[at] = self.made[r]
            tok[gone] = -1
            nxt[at] = after
            has = after >= 0
            prv[after[has]] = at[has]
            before = prv[at]
            add(np.concatenate([before[before >= 0], at]))
        kept = tok >= 0
        counts = np.add.reduceat(kept, np.minimum(ends - lens, n - 1)).astype(np.int64)
        return tok[kept], np.where(lens > 0, counts, 0)

    # ---------------------------------------------------------- encoding
    def reset(self) -> None:
        special = sorted(self.added.values())
        self.known = np.array(special, np.uint64)
        self.known_start = np.arange(len(special))
        self.known_len = np.ones(len(special), np.int64)
        self.store = np.array(special, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and their offsets."""
        starts, ends, h = self.pieces(data, offsets)
        inv, uniq = pd.factorize(h)
        where = np.empty(len(uniq), np.int64)
        where[inv] = np.arange(len(h))
        if len(self.known) > CACHE_PIECES:
            self.reset()
        at, there = in_sorted(self.known, uniq)
        if not there.all():
            new = where[~there]
            lens = ends[new] - starts[new]
            ids, count = self.merge(data[ragged(starts[new], lens)], lens)
            known = np.concatenate([self.known, uniq[~there]])
            first = np.concatenate([self.known_start, len(self.store) + np.cumsum(count) - count])
            length = np.concatenate([self.known_len, count])
            order = np.argsort(known, kind="stable")
            self.known, self.known_start, self.known_len = known[order], first[order], length[order]
            self.store = np.concatenate([self.store, ids])
            at, _ = in_sorted(self.known, uniq)
        lens = self.known_len[at][inv]
        ids = self.store[ragged(self.known_start[at][inv], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])
        return ids.astype("<u4"), total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all rows and their offsets."""
        lens = self.vocab_lens[ids]
        total = np.concatenate([[0], np.cumsum(lens)])
        return self.vocab_bytes[ragged(self.vocab_starts[ids], lens)], total[offsets]


_LOADED: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    """One encoder per file and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def gathered(batches, columns: list[str], text_col: str, limit: int = PARTITION_BYTES
             ) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Arrow batches put together up to ``limit`` bytes of text (or one batch)."""
    kept, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        data, off = utf8(b.column(b.schema.get_field_index(text_col)))
        for lo, hi in chunks(off, limit):
            if kept and size + off[hi] - off[lo] > limit:
                yield _joined(kept)
                kept, size = [], 0
            part = b.slice(lo, hi - lo)
            kept.append((part.select(columns), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]))
            size += off[hi] - off[lo]
    if kept:
        yield _joined(kept)


def _joined(kept):
    table = pa.Table.from_batches([k[0] for k in kept]).combine_chunks()
    data = kept[0][1] if len(kept) == 1 else np.concatenate([k[1] for k in kept])
    sizes = np.concatenate([np.diff(k[2]) for k in kept])
    return table, data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = False) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256[, ids binary])`` of every row;
    ``ids`` holds little-endian unsigned 32-bit integers."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()),
                           *([T.StructField("ids", T.BinaryType())] if ids else [])])

    def run(batches):
        bpe = tokenizer(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for table, data, off in gathered(batches, ["id"], "text"):
            tokens, t_off = bpe.encode(data, off)
            for lo, hi in chunks(t_off, 1 << 20):
                part = tokens[t_off[lo]:t_off[hi]]
                o = t_off[lo:hi + 1] - t_off[lo]
                back, b_off = bpe.decode(part, o)
                cells = [part[a:b].tobytes() for a, b in zip(o[:-1], o[1:])]
                cols = [table.column(0).slice(lo, hi - lo).combine_chunks(), pa.array(np.diff(o)),
                        pa.array([sha(c) for c in cells], pa.string()),
                        pa.array([sha(back[a:b].tobytes()) for a, b in zip(b_off[:-1], b_off[1:])], pa.string())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(cells, pa.binary())] if ids else []),
                                                 names=[f.name for f in schema.fields])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, schema)
