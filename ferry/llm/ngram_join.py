"""N-gram Jaccard join by universe partition and pigeonhole (operator 8).

A document's set are the 64-bit hashes of its distinct five-word shingles.
Equal sets are one class. Sets fall into size bands whose sizes differ by at
most the factor 4/3; in a band the universe of shingles is cut by hash into
segments. Two sets of sizes x and y with similarity of at least 3/4 differ in
at most H = (x + y) / 7 shingles, so of any H + 1 segments one holds the same
subset in both. Each set indexes its subset of every segment of its band, and
in some segments also the subsets with one deletion; it probes its own band
and the one below (the smaller partner is the indexed one).

Allocation is by cost. A probe must choose increments worth H + 1: a segment
gives one (equal subsets), a second one if it also allows for one difference
through the deletion neighbourhoods. The cost of a subset is the number of
sets that share it. Subsets nobody shares come first, they cost nothing: a
set with H + 1 of them has no partner and drops out. Others take the cheapest
shared subsets they still need. Empty subsets are never used; a set whose
subsets and neighbourhoods can't make up H + 1 (a few tiny ones) is compared
with all sets of fitting size, in blocks.

Candidates are verified exactly on the sets. A group of sets that share a
subset first meets one hub each (the member with the fewest private subsets);
only members that the verified links leave in different components are then
paired, so no group is expanded into all its pairs.

Rows: null or wordless texts have the empty set and link with nothing; a text
of one to four words is one shingle; repeated rows and copies are one class;
null ids take part but are never a component's name unless alone; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.llm.components import components
from ferry.llm.textbatch import (LOWER, MULT, chunks, give_back, in_sorted, lean, mix, ragged, span_hashes, utf8,
                                 words)
from ferry.plans.sizing import materialize

WORDS = 5
#: Segments for each shingle of a band's largest set: many for short texts, where a
#: common passage is a large part and private subsets must outweigh it.
SEGMENTS, SHORT_SEGMENTS, SHORT = 0.45, 1.5, 320
#: Bands up to this size have deletion neighbourhoods in every segment, others in one of sixteen.
SMALL = 40
#: Text bytes for each bucket of signatures.
BUCKET_BYTES = 12 << 20
#: Ids of at most this many documents are broadcast; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
BLOCK = 1000
#: Signatures packed together by a task.
FLUSH = 600_000
#: Cells of the histograms that bound what two classes can share.
CELLS = 32
EXACT, DELETED = np.uint64(0x1F), np.uint64(0x2F)


def _bands(top: int) -> np.ndarray:
    """Largest size of every band, until ``top`` is covered."""
    out, low = [], 1
    while not out or out[-1] < top:
        out.append(4 * low // 3)
        low = out[-1] + 1
    return np.array(out, np.int64)


HIGH = _bands(1 << 40)


def band_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(HIGH, n, "left")


def segments(band: np.ndarray) -> np.ndarray:
    return (np.where(HIGH[band] <= SHORT, SHORT_SEGMENTS, SEGMENTS) * HIGH[band]).astype(np.int64) + 2


def deletion_segments(band: np.ndarray) -> np.ndarray:
    m = segments(band)
    return np.where(HIGH[band] <= SMALL, m, m // 16 + 1)


def differences(n: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Most differences of a probe of size n to a linked, not larger set of the band."""
    return (n + np.minimum(n, HIGH[band])) // 7


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and offsets."""
    d = LOWER[data]
    s, e, wo = words(d, off)
    h = span_hashes(d, s, e)
    n_words = np.diff(wo)
    first = wo[:-1]
    count = np.where(n_words >= WORDS, n_words - WORDS + 1, 0)
    at = ragged(first, count)
    sh = np.zeros(len(at), np.uint64)
    for j in range(WORDS):
        sh += h[at + j] * MULT[8 + j] if len(at) else 0
    rows = np.repeat(np.arange(len(first)), count)
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(short):
        extra = np.array([sum(int(x) * int(MULT[20 + j]) for j, x in enumerate(h[wo[r]:wo[r + 1]]))
                          + int(n_words[r]) & (1 << 64) - 1 for r in short], np.uint64)
        sh, rows = np.concatenate([sh, extra]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        sh, rows = sh[order], rows[order]
    sh = mix(sh)
    edge = np.searchsorted(rows, np.arange(len(off)))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        sh[a:b].sort()
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (rows[1:] != rows[:-1])
    sh, rows = sh[new], rows[new]
    return sh, np.searchsorted(rows, np.arange(len(off)))


def class_keys(sh: np.ndarray, so: np.ndarray) -> np.ndarray:
    """Key of every set, 0 for the empty one."""
    out = np.zeros(len(so) - 1, np.uint64)
    for i in np.flatnonzero(np.diff(so)):
        out[i] = int.from_bytes(hashlib.blake2b(sh[so[i]:so[i + 1]].tobytes(), digest_size=8).digest(), "little") | 1
    return out


class Cut:
    """Sets cut into the segments of given bands: one entry per non-empty
    (set, segment), with its hash, size and members."""

    def __init__(self, sh: np.ndarray, so: np.ndarray, rows: np.ndarray, band: np.ndarray):
        n = np.diff(so)[rows]
        at = ragged(so[:-1][rows], n)
        own = np.repeat(np.arange(len(rows)), n)
        m = segments(band).astype(np.uint64)
        token = sh[at]
        seg = ((token >> np.uint64(20)) % m[own]).astype(np.int64)
        order = np.argsort(own << 32 | seg)
        self.token, self.own, seg = token[order], own[order], seg[order]
        new = np.ones(len(seg), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (self.own[1:] != self.own[:-1])
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(seg)))
        self.row, self.segment = self.own[self.first], seg[self.first]
        # a subset's hash is the sum of its members' hashes: a deletion subtracts one
        self.value = mix(self.token * MULT[30])
        self.sum = np.add.reduceat(self.value, self.first) if len(self.first) else np.zeros(0, np.uint64)
        self.salt = mix(band[self.row].astype(np.uint64) * MULT[31] + self.segment.astype(np.uint64) * MULT[32])
        self.deletable = (self.segment < deletion_segments(band)[self.row]) & (self.size >= 2)
        self.filled = np.bincount(self.row, minlength=len(rows))

    def exact(self, kind: np.uint64) -> np.ndarray:
        return mix(self.sum + self.salt + kind)

    def deleted(self, entries: np.ndarray, kind: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the subsets less one member, and their sets."""
        at = ragged(self.first[entries], self.size[entries])
        e = np.repeat(entries, self.size[entries])
        return mix(self.sum[e] - self.value[at] + self.salt[e] + kind), self.row[e]


def needs(sh: np.ndarray, so: np.ndarray, rows: np.ndarray, band: np.ndarray):
    """The cut, the increments each set needs, and those it must take from
    deletion neighbourhoods; a negative third value: it can't make them up."""
    cut = Cut(sh, so, rows, band)
    need = differences(np.diff(so)[rows], band) + 1
    lack = np.maximum(need - cut.filled, 0)
    can = np.bincount(cut.row[cut.deletable], minlength=len(rows))
    return cut, need, np.where(can >= lack, lack, -1)


def _probe_bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, band) of every probe, and whether it is the set's own band."""
    rows = np.flatnonzero(n > 0)
    own = band_of(n[rows])
    low = (own > 0) & (4 * HIGH[np.maximum(own - 1, 0)] >= 3 * n[rows])
    return (np.concatenate([rows, rows[low]]), np.concatenate([own, own[low] - 1]),
            np.concatenate([np.ones(len(rows), bool), np.zeros(int(low.sum()), bool)]))


def _sets_in(batch_column):
    data, off = utf8(batch_column)
    for lo, hi in chunks(off):
        sh, so = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        yield lo, hi, sh, so


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64).view(np.int64))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, class_key)`` of every row; the key is null for the empty set."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, sh, so in _sets_in(b.column(1)):
                key = class_keys(sh, so)
                n = np.diff(so)
                odd = np.zeros(len(n), bool)
                rows, band, _ = _probe_bands(n)
                if len(rows):
                    odd[rows[needs(sh, so, rows, band)[2] < 0]] = True
                own = [sh[so[i]:so[i + 1]].tobytes() if o else None for i, o in enumerate(odd)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array(key.view(np.int64), mask=n == 0), pa.array(own, pa.binary())],
                    names=["id", "n_shingles", "ck", "odd"])

    return src.mapInArrow(lean(run), f"id {kind}, n_shingles long, ck long, odd binary")


# Roles of a signature.
INDEX, PROBE, FORCED = 1, 2, 4


def _signatures(sh, so, key) -> tuple[np.ndarray, ...]:
    """(signature, row, role, probe band's need left after private subsets are
    counted later) of a batch."""
    n = np.diff(so)
    rows, band, own = _probe_bands(n)
    cut, need, lack = needs(sh, so, rows, band)
    sig = [cut.exact(EXACT)]
    who = [cut.row]
    role = [np.where(own[cut.row], INDEX | PROBE, PROBE)]
    # one-deletion index of the own band
    entries = np.flatnonzero(cut.deletable & own[cut.row])
    d, r = cut.deleted(entries, DELETED)
    sig.append(d), who.append(r), role.append(np.full(len(d), INDEX))
    # second increments of probes that need them: their first deletable segments
    if (lack > 0).any():
        cand = np.flatnonzero(cut.deletable & (lack[cut.row] > 0))
        first = np.searchsorted(cut.row[cand], cut.row[cand], "left")
        cand = cand[np.arange(len(cand)) - first < lack[cut.row[cand]]]
        d, r = cut.deleted(cand, EXACT)
        sig.append(d), who.append(r), role.append(np.full(len(d), FORCED))
        sig.append(mix(cut.sum[cand] + cut.salt[cand] + DELETED))
        who.append(cut.row[cand]), role.append(np.full(len(cand), FORCED))
    sig, who, role = np.concatenate(sig), np.concatenate(who), np.concatenate(role)
    # what private subsets must reach for the set to drop out of this band
    spare = cut.filled - need
    return sig, rows[who], role, band[who], np.maximum(spare, 0)[who]


def shared_signatures(docs: DataFrame, buckets: int, text_col: str = "text") -> DataFrame:
    """``(sig, ck, n, role, band, spare, freq)`` of signatures that two or more
    classes have, one of them as a probe; freq is the number of classes."""
    packed = "bucket int, sig binary, who binary, role binary, band binary, spare binary, ck binary, n binary"

    def emit(batches):
        for b in batches:
            seen: set[int] = set()
            parts, held = [], 0
            for _, _, sh, so in _sets_in(b.column(0)):
                key = class_keys(sh, so)
                fresh = np.array([k != 0 and not (int(k) in seen or seen.add(int(k))) for k in key], bool)
                if not fresh.any():
                    continue
                keep = np.flatnonzero(fresh)
                size = np.diff(so)[keep]
                sh, so = sh[ragged(so[:-1][keep], size)], np.concatenate([[0], np.cumsum(size)])
                sig, who, role, band, spare = _signatures(sh, so, key[keep])
                parts.append((sig, key[keep][who], size[who].astype(np.uint32), role.astype(np.uint8),
                              band.astype(np.uint8), spare.astype(np.uint32)))
                held += len(sig)
                if held > FLUSH:
                    yield pack(parts)
                    parts, held = [], 0
            if parts:
                yield pack(parts)

    def pack(parts):
        sig, ck, n, role, band, spare = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(sig)
        sig, ck, n, role, band, spare = (x[order] for x in (sig, ck, n, role, band, spare))
        edges = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** 64 / buckets)).astype(np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(sig, edges), [len(sig)]])
        cols: list[list] = [[] for _ in range(8)]
        for k in np.flatnonzero(np.diff(cuts)):
            a, z = cuts[k], cuts[k + 1]
            # classes (key, size, spare by band) are listed once, entries point to them
            tag = ck[a:z] ^ (band[a:z].astype(np.uint64) << np.uint64(1))
            _, one, inv = np.unique(tag, return_index=True, return_inverse=True)
            for c, x in zip(cols, (int(k), ((sig[a:z] >> np.uint64(12)) & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                                   inv.astype(np.uint32).tobytes(), role[a:z].astype(np.uint8).tobytes(),
                                   band[a:z][one].astype(np.uint8).tobytes(), spare[a:z][one].astype(np.uint32).tobytes(),
                                   ck[a:z][one].tobytes(), n[a:z][one].astype(np.uint32).tobytes())):
                c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                         names=["bucket", "sig", "who", "role", "band", "spare", "ck", "n"])

    def meet(table):
        kinds = {"sig": np.uint32, "who": np.uint32, "role": np.uint8, "band": np.uint8, "spare": np.uint32,
                 "ck": np.uint64, "n": np.uint32}
        col = {c: [np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in kinds.items()}
        base = np.cumsum([0] + [len(x) for x in col["ck"]]).astype(np.uint32)
        who = np.concatenate([w + o for w, o in zip(col["who"], base)])
        role, band, spare, ck, n = (np.concatenate(col[c]) for c in ("role", "band", "spare", "ck", "n"))
        # the band is part of what a signature means: 32 stored bits and the band
        full = np.concatenate(col["sig"]).astype(np.uint64)
        del col
        full <<= np.uint64(8)
        full |= band[who]
        # most signatures stand alone, and go before anything else is made of them
        twice = np.sort(full)
        twice = np.unique(twice[1:][twice[1:] == twice[:-1]])
        at = np.concatenate([np.flatnonzero(in_sorted(twice, full[i:i + FLUSH])[1]) + i
                             for i in range(0, len(full), FLUSH)])
        full, who, role = full[at], who[at], role[at]
        group = np.searchsorted(twice, full)
        key = ck[who]
        order = np.lexsort((key, group))
        full, who, role, group, key = (x[order] for x in (full, who, role, group, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        if len(first):
            role = np.bitwise_or.reduceat(role, first)
        full, who, group, key = full[first], who[first], group[first], key[first]
        size = np.bincount(group) if len(group) else np.zeros(0, int)
        probes = np.bincount(group, (role & (PROBE | FORCED)) > 0) if len(group) else np.zeros(0)
        index = np.bincount(group, (role & INDEX) > 0) if len(group) else np.zeros(0)
        ok = (size > 1) & (probes > 0) & (index > 0)
        keep = np.flatnonzero(ok[group]) if len(group) else np.zeros(0, int)
        bucket = int(table.column("bucket")[0].as_py())
        sid = full[keep].astype(np.int64) + (np.int64(bucket) << 42)
        w = who[keep]
        give_back()
        return pa.table({"sig": pa.array(sid), "ck": _longs(key[keep]), "n": pa.array(n[w].astype(np.int64)),
                         "role": pa.array(role[keep].astype(np.int32)), "band": pa.array(band[w].astype(np.int32)),
                         "spare": pa.array(spare[w].astype(np.int64)),
                         "freq": pa.array(size[group[keep]].astype(np.int64))})

    blobs = docs.select(docs[text_col].alias("text")).mapInArrow(lean(emit), packed)
    return (blobs.repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(meet, "sig long, ck long, n long, role int, band int, spare long, freq long"))


def allocate(shared: DataFrame) -> DataFrame:
    """Marks the signatures that a class probes and those where it still
    counts as indexed.

    With ``spare`` subsets more than it needs and s shared ones, a class must
    probe s - spare of them, the cheapest; without such a need it drops out as
    a probe. A class of size n with more than n / 3 private subsets has no
    larger partner, so it drops out of the index."""
    probe = F.col("role").bitwiseAND(F.lit(PROBE)) > 0
    # A class's own subsets, never more than its shingles, meet in one window.
    order = Window.partitionBy("ck", "band", "probing").orderBy("freq", "sig")
    whole = Window.partitionBy("ck", "band")
    ranked = (shared.withColumn("probing", probe).withColumn("rank", F.row_number().over(order))
              .withColumn("own", F.sum(F.col("probing").cast("long")).over(whole)))
    chosen = (F.col("probing") & (F.col("rank") <= F.col("own") - F.col("spare"))) \
        | (F.col("role").bitwiseAND(F.lit(FORCED)) > 0)
    private = F.col("spare") + F.expr("2 * n div 7") + 1 - F.col("own")
    index = (F.col("role").bitwiseAND(F.lit(INDEX)) > 0) & (
        (F.col("spare") == 0) | (private <= F.expr("n div 3")))
    return ranked.select("sig", "ck", "n", F.coalesce(chosen, F.lit(False)).alias("probes"), index.alias("index"),
                         (F.col("own") - F.col("spare")).alias("weight")).filter("probes or index")


def _fits(x: str, y: str):
    """Sizes allow a link: 4 * the smaller >= 3 * the larger."""
    return F.least(x, y) * 4 >= F.greatest(x, y) * 3


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, both, linked)`` of candidate pairs (a, b): the shingles they
    share, counted on the sets, and whether that links them."""
    def run(batches):
        for b in batches:
            both, linked = [], []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                k = int(in_sorted(x, y)[1].sum())
                both.append(k)
                linked.append(100 * k >= 75 * (len(x) + len(y) - k))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()),
                                              pa.array(linked, pa.bool_())], names=["a", "b", "both", "linked"])

    joined = (pairs.join(sets.select(F.col("ck").alias("b"), F.col("members").alias("sb")), "b")
              .join(sets.select(F.col("ck").alias("a"), F.col("members").alias("sa")), "a").select("a", "b", "sa", "sb"))
    return joined.mapInArrow(lean(run), "a long, b long, both long, linked boolean")


def _references(tested: DataFrame, sets: DataFrame) -> DataFrame:
    """``(ck, ref, inside)``: for every class that met a hub, the hub that met
    most classes, and how many shingles they share."""
    met = tested.select(F.col("a").alias("ck"), F.col("b").alias("ref"), F.col("both").alias("inside")).union(
        tested.select("b", "a", "both"))
    own = sets.select("ck", F.col("ck").alias("ref"), (F.octet_length("members") / 8).cast("long").alias("inside"))
    degree = met.groupBy("ref").agg(F.count(F.lit(1)).alias("degree"))
    return (met.union(own).join(degree, "ref").groupBy("ck")
            .agg(F.max(F.struct("degree", "ref", "inside")).alias("best")).select("ck", "best.ref", "best.inside"))


def _can_share(x: str, y: str):
    """Upper bounds on the shingles two classes share allow a link: neither
    class's lone shingles are shared, and of a common reference set each holds
    ``inside`` shingles, so at most the smaller number of these and of the
    rest are shared; nor more than the smaller number in each hash cell."""
    def col(c, f):
        return F.col(f"{c}.{f}")

    most = F.least(col(x, "n") - col(x, "alone"), col(y, "n") - col(y, "alone"))
    near = (F.least(col(x, "inside"), col(y, "inside"))
            + F.least(*[col(c, "n") - col(c, "inside") - col(c, "alone") for c in (x, y)]))
    same = F.coalesce(col(x, "ref") == col(y, "ref"), F.lit(False))
    total = col(x, "n") + col(y, "n")
    each = F.zip_with(col(x, "cells"), col(y, "cells"), lambda i, j: F.least(i, j))
    in_cells = F.aggregate(each, F.lit(0), lambda acc, k: acc + k)
    return (((col(x, "alone") + col(y, "alone")) * 7 <= total)
            & (F.when(same, F.least(most, near)).otherwise(most) * 7 >= total * 3) & (in_cells * 7 >= total * 3))


def _sharing_enough(apart: DataFrame, sets: DataFrame, refs: DataFrame) -> DataFrame:
    """``apart`` with the number ``alone`` of each class's shingles that no
    other class in it has. Two classes differ in at least the sum of these,
    so a class with more than n / 7 + (4 n / 3) / 7 of them has no partner."""
    rows = materialize(apart, "jaccard-apart")
    # The references count too, so a lone shingle is in none of them.
    both = rows.select("ck").union(refs.join(rows.select("ck").distinct(), "ck", "left_semi").select("ref")).distinct()
    here = sets.join(both, "ck", "left_semi")

    def tokens(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            members = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            for i in range(0, len(members), 1000):
                part = members[i:i + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)), pa.array(np.repeat(keys[i:i + 1000], [len(x) for x in part]))],
                    names=["token", "ck"])

    lone = (here.select("ck", "members").mapInArrow(tokens, "token long, ck long").groupBy("token")
            .agg(F.count(F.lit(1)).alias("k"), F.min("ck").alias("ck")).filter("k = 1")
            .groupBy("ck").agg(F.collect_list("token").alias("lone")))

    def cells(batches):
        for b in batches:
            alone, counts = [], []
            for x, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                x = np.frombuffer(x, np.uint64)
                gone = np.sort(np.array(gone or [], np.int64).view(np.uint64))
                x = x[~in_sorted(gone, x)[1]]
                alone.append(len(gone))
                counts.append(np.bincount((x >> np.uint64(7)).astype(np.int64) % CELLS, minlength=CELLS).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(alone, pa.int64()), pa.array(counts, pa.list_(pa.int32()))],
                                             names=["ck", "alone", "cells"])

    facts = here.join(lone, "ck", "left").select("ck", "members", "lone").mapInArrow(
        cells, "ck long, alone long, cells array<int>")
    return materialize(rows.join(facts, "ck").join(refs, "ck", "left").filter("alone * 3 <= n"), "jaccard-apart")


def _odd_links(docs: DataFrame, classes: DataFrame, text_col: str) -> list[DataFrame]:
    """Links of the few sets that segments can't serve: each block of them
    against all sets, exactly."""
    odd = classes.filter(F.col("odd").isNotNull()).select("ck", "odd").dropDuplicates(["ck"])
    out = []
    total = odd.count()
    blocks = -(-total // BLOCK)
    for k in range(blocks):
        part = odd.filter(F.pmod(F.xxhash64("ck"), F.lit(blocks)) == k).toPandas()
        sent = docs.sparkSession.sparkContext.broadcast(
            [(int(c), np.frombuffer(s, np.uint64)) for c, s in zip(part["ck"], part["odd"])])

        def run(batches, sent=sent):
            mine = sent.value
            tokens = np.unique(np.concatenate([s for _, s in mine])) if mine else np.zeros(0, np.uint64)
            for b in batches:
                for _, _, sh, so in _sets_in(b.column(0)):
                    hit = np.concatenate([[0], np.cumsum(in_sorted(tokens, sh)[1])])
                    key = class_keys(sh, so).view(np.int64)
                    a, z = [], []
                    for i in np.flatnonzero(hit[so[1:]] > hit[so[:-1]]):
                        x = sh[so[i]:so[i + 1]]
                        for c, s in mine:
                            both = int(in_sorted(x, s)[1].sum())
                            if c != key[i] and 100 * both >= 75 * (len(x) + len(s) - both):
                                a.append(int(key[i])), z.append(c)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

        out.append(docs.select(docs[text_col].alias("text")).mapInArrow(run, "a long, b long"))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row."""
    spark = docs.sparkSession
    classes = materialize(jaccard_classes(docs, id_col, text_col), "jaccard-classes")
    size = docs.agg(F.sum(F.octet_length(docs[text_col])).alias("n")).first()["n"] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    shared = materialize(allocate(shared_signatures(docs, int(buckets), text_col)), "jaccard-shared")
    # Groups that still have a probe.
    live = (shared.groupBy("sig").agg(F.max("probes").alias("live"), F.max("index").alias("there"),
                                      F.count(F.lit(1)).alias("size")).filter("live and there and size > 1").select("sig"))
    group = materialize(shared.join(live, "sig", "left_semi"), "jaccard-groups")
    # The hub of a group: the member with the fewest private subsets.
    hubs = group.groupBy("sig").agg(F.max(F.struct("weight", "ck", "n", "probes", "index")).alias("hub"))
    stars = (group.join(hubs, "sig")
             .filter((F.col("ck") != F.col("hub.ck")) & (F.col("probes") | F.col("hub.probes")) & _fits("n", "hub.n"))
             .select(F.least("ck", "hub.ck").alias("a"), F.greatest("ck", "hub.ck").alias("b")).distinct())
    stars = materialize(stars, "jaccard-stars")
    # One row of each class that is in a group, with its set.
    wanted = group.select("ck").distinct()
    first = classes.filter("ck is not null").groupBy("ck").agg(F.min("id").alias("id"))
    wanted = materialize(first.join(wanted, "ck"), "jaccard-wanted")
    ids = wanted.select("id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    src = rows.join(ids, "id", "left_semi")
    # No id finds a class whose rows all have null ids: the key of each such row is looked at.
    if wanted.filter("id is null").limit(1).count():
        src = src.union(rows.filter("id is null"))

    def members(batches):
        for b in batches:
            for _, _, sh, so in _sets_in(b.column(0)):
                key = class_keys(sh, so)
                at = np.flatnonzero(key)
                yield pa.RecordBatch.from_arrays(
                    [_longs(key[at]), pa.array([sh[so[i]:so[i + 1]].tobytes() for i in at], pa.binary())],
                    names=["ck", "members"])

    sets = materialize(src.select("text").mapInArrow(lean(members), "ck long, members binary")
                       .join(wanted.select("ck"), "ck", "left_semi").dropDuplicates(["ck"]), "jaccard-sets")
    tested = materialize(_verified(stars, sets), "jaccard-tested")
    links = tested.filter("linked").select("a", "b")
    for more in _odd_links(docs, classes, text_col):
        links = links.union(materialize(more, "jaccard-odd"))
    labels = components(links)
    # Members that are still apart: only groups of more than one component.
    named = group.join(labels.withColumnRenamed("node", "ck"), "ck", "left") \
        .withColumn("label", F.coalesce("label", "ck"))
    mixed = (named.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .filter("lo <> hi").select("sig"))
    apart = _sharing_enough(named.join(mixed, "sig", "left_semi"), sets, _references(tested, sets))
    facts = ("ck", "n", "label", "alone", "ref", "inside", "cells")
    x = apart.filter("probes").select("sig", F.struct(*facts).alias("x"))
    y = apart.filter("index").select("sig", F.struct(*facts).alias("y"))
    pairs = (x.join(y, "sig").filter((F.col("x.label") != F.col("y.label")) & (F.col("y.n") <= F.col("x.n"))
                                     & _fits("x.n", "y.n") & _can_share("x", "y"))
             .select(F.least("x.ck", "y.ck").alias("a"), F.greatest("x.ck", "y.ck").alias("b")).distinct()
             .join(stars, ["a", "b"], "left_anti"))
    more = materialize(_verified(pairs, sets).filter("linked").select("a", "b"), "jaccard-links")
    if more.limit(1).count():
        labels = components(links.union(more))
    rows = classes.join(labels.withColumnRenamed("node", "ck"), "ck", "left") \
        .withColumn("label", F.coalesce("label", "ck"))
    name = rows.filter("label is not null").groupBy("label").agg(F.min("id").alias("component"))
    return rows.join(name, "label", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns kept, with one row of each component: the one
    with the smallest (id, row number)."""
    rid = "__row"
    while rid in docs.columns:
        rid += "_"
    rows = docs.withColumn(rid, F.struct(F.col(id_col).alias("i"), F.monotonically_increasing_id().alias("r")))
    gone = near_duplicates(rows, rid, text_col).filter(F.col(rid) != F.col("component_id")).select(rid)
    return rows.join(gone, rid, "left_anti").drop(rid)
