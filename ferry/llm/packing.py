"""Lexical retrieval packing (operator 9).

Documents are token ids with one end id. A document fills its own windows as
far as it goes; what is left, its tail, is packed with the tails that are
lexically nearest. Tails are dealt by range of their two most telling terms
into shards of bounded size (a hot term splits by row id), each with an
inverted BM25 index of its own over all its tails; the terms are token ids
and their document frequencies come from all rows' tails, so a document
without a tail counts in none. In a shard, a seed asks the index for its 64
best unused neighbours, which fill its window in order of their score; the
one that doesn't fit is cut, and its rest seeds the next window. Neighbours
beyond these 64 aren't asked for: the next tail in order goes on as a seed.
What the last window of a shard lacks is avoided: its tokens are cut into
sequences of powers of two, which need no padding.

The query of a seed is its ``QUERY_TERMS`` heaviest terms; tails that no term
finds follow in order, so every tail is placed.

Rows: null text counts as empty (the end id alone); repeated rows are packed
each; null ids are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.bpe import gathered, tokenizer
from ferry.llm.textbatch import ragged
from ferry.plans.sizing import materialize

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 2_000_000
QUERY_TERMS = 12
K1, B = 1.2, 0.75
IDS = 1 << 16


def _units(docs: DataFrame, path: str, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per document: its number of ids, the checksums of the windows
    it fills, and its tail as unsigned 16-bit ids."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        bpe = tokenizer(path)
        for table, data, off in gathered(batches, ["id"], "text"):
            ids, o = bpe.encode(data, off)
            n = len(o) - 1
            flat = np.full(len(ids) + n, END_ID, "<u4")
            flat[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(o))] = ids
            o = o + np.arange(n + 1)
            raw, tails = flat.view(np.uint8), flat.astype("<u2")
            sums, rest = [], []
            for a, b in zip(o[:-1].tolist(), o[1:].tolist()):
                last = b - (b - a) % window
                sums.append([zlib.crc32(raw[4 * i:4 * (i + window)]) for i in range(a, last, window)])
                rest.append(tails[last:b].tobytes())
            yield from pa.Table.from_arrays(
                [table.column(0), pa.array(np.diff(o)), pa.array(sums, pa.list_(pa.int64())),
                 pa.array(rest, pa.binary())], names=["id", "doc_tokens", "sums", "tail"]).to_batches(20_000)

    return src.mapInArrow(run, f"id {kind}, doc_tokens long, sums array<long>, tail binary")


def _terms(tails: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms by tail: (tail, term, count), and tail lengths."""
    lens = np.array([len(t) // 2 for t in tails], np.int64)
    ids = np.frombuffer(b"".join(tails), "<u2").astype(np.int64)
    key, n = np.unique(np.repeat(np.arange(len(tails)), lens) * IDS + ids, return_counts=True)
    return key // IDS, key % IDS, n, lens


class Statistics:
    """BM25 weights from the frequencies of all tails."""

    def __init__(self, frequency: np.ndarray, n_tails: int, mean_length: float):
        self.idf = np.log1p((n_tails - frequency + 0.5) / (frequency + 0.5))
        self.mean_length = max(mean_length, 1.0)

    def weights(self, row, term, n, lens):
        norm = K1 * (1 - B + B * lens[row] / self.mean_length)
        return self.idf[term] * n * (K1 + 1) / (n + norm)


def _heaviest(row: np.ndarray, weight: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries in order of row and falling weight, and each row's range of
    at most ``k``."""
    order = np.lexsort((-weight, row))
    first = np.searchsorted(row[order], np.arange(n_rows + 1))
    return order, np.column_stack([first[:-1], np.minimum(first[:-1] + k, first[1:])])


def pack_shard(tails: list[bytes], stats: Statistics, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (tail, start, length, sequence, offset) of one shard."""
    row, term, n, lens = _terms(tails)
    weight = stats.weights(row, term, n, lens)
    order, top = _heaviest(row, weight, len(tails), QUERY_TERMS)
    by_term = np.argsort(term, kind="stable")
    post_row, post_weight = row[by_term], weight[by_term]
    edge = np.searchsorted(term[by_term], np.arange(IDS + 1))
    free = lens > 0
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, used, left_to_place = 0, 0, int(lens.sum())
    next_free = 0
    full_until = left_to_place - left_to_place % window

    def room() -> int:
        """Size of the sequence that is being filled."""
        done = int(lens.sum()) - left_to_place - used
        if done < full_until:
            return window
        return 1 << (int(lens.sum()) - done).bit_length() - 1

    size = room() if left_to_place else 0

    def put(tail: int, start: int, length: int) -> None:
        nonlocal sequence, used, left_to_place, size
        while length:
            part = min(length, size - used)
            pieces.append((tail, start, part, sequence, used))
            used, left_to_place = used + part, left_to_place - part
            start, length = start + part, length - part
            if used == size:
                sequence, used = sequence + 1, 0
                size = room() if left_to_place else 0

    def neighbours(seed: int) -> np.ndarray:
        lo, hi = top[seed]
        terms = term[order[lo:hi]]
        at = ragged(edge[terms], edge[terms + 1] - edge[terms])
        score = np.bincount(post_row[at], post_weight[at], len(tails))
        score[~free] = 0
        near = np.flatnonzero(score)
        if len(near) > 64:
            near = near[np.argpartition(-score[near], 64)[:64]]
        return near[np.lexsort((near, -score[near]))]

    while left_to_place:
        while not free[next_free]:
            next_free += 1
        seed, start = next_free, 0
        while seed >= 0:  # a cut tail seeds the next window
            free[seed] = False
            before = sequence
            put(seed, start, int(lens[seed]) - start)
            if sequence != before and used == 0:
                break
            cut = -1
            for other in neighbours(seed).tolist():
                free[other] = False
                gap = size - used
                length = int(lens[other])
                if length <= gap:
                    put(other, 0, length)
                    if used == 0:
                        break
                else:
                    put(other, 0, gap)
                    cut, start = other, gap
                    break
            seed = cut
    return pieces


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of
    every piece."""
    spark = docs.sparkSession
    units = materialize(_units(docs, path, id_col, text_col, window), "packing-units")
    kind = units.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")
    # A document's own windows; even sequence ids.
    own = (units.select("id", "doc_tokens", F.posexplode("sums").alias("k", "ids_crc32"))
           .select(F.col("id").alias(id_col), (F.col("k") * window).cast("long").alias("start"),
                   F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                   (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rest = units.filter(F.octet_length("tail") > 0).select("id", "doc_tokens", "tail")

    def frequencies(batches):
        total = np.zeros(IDS, np.int64)
        for b in batches:
            if b.num_rows:
                total += np.bincount(_terms(b.column(0).to_pylist())[1], minlength=IDS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "n"])

    # One row a vocabulary id at most.
    found = (rest.select("tail").mapInArrow(frequencies, "term int, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    frequency = np.zeros(IDS)
    frequency[found["term"].to_numpy()] = found["n"].to_numpy()
    total = rest.agg(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.sum(F.octet_length("tail") / 2), F.lit(0.0)).alias("tokens")).first()
    stats = Statistics(frequency, total["n"], total["tokens"] / max(total["n"], 1))
    sent = spark.sparkContext.broadcast(stats)

    def route(batches):
        for b in batches:
            tails = b.column(2).to_pylist()
            if not tails:
                continue
            row, term, n, lens = _terms(tails)
            order, top = _heaviest(row, sent.value.weights(row, term, n, lens), len(tails), 2)
            one, two = term[order[top[:, 0]]], term[order[top[:, 1] - 1]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32))],
                                             names=[*b.schema.names, "one", "two"])

    shards = max(1, math.ceil(total["tokens"] / SHARD_TOKENS))
    routed = rest.mapInArrow(route, f"id {kind}, doc_tokens long, tail binary, one int, two int")

    def pack(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept).combine_chunks()
        tails = table.column("tail").to_pylist()
        pieces = np.array(pack_shard(tails, sent.value, window), np.int64).reshape(-1, 5)
        sums = [zlib.crc32(np.frombuffer(tails[t], "<u2")[s:s + k].astype("<u4")) for t, s, k in pieces[:, :3].tolist()]
        count = table.column("doc_tokens").to_numpy()[pieces[:, 0]]
        start = count - count % window + pieces[:, 1]
        yield from pa.Table.from_arrays(
            [table.column("id").take(pa.array(pieces[:, 0])), pa.array(start), pa.array(pieces[:, 2]),
             pa.array(sums, pa.int64()), pa.array(count), pa.array(((shard << 32) + pieces[:, 3]) * 2 + 1),
             pa.array(pieces[:, 4])],
            names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]).to_batches(50_000)

    packed = (routed.repartitionByRange(shards, "one", "two", F.xxhash64("id", "tail"))
              .sortWithinPartitions("one", "two", "id", "tail").mapInArrow(pack, schema))
    return own.unionByName(packed)
