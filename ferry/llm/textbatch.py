"""Vectorised helpers over Arrow batches of texts.

A batch is looked at as one UTF-8 byte array plus offsets, so words, hashes
and windows of thousands of documents come from a few numpy calls. Hashes are
64-bit values of a random polynomial (fixed seed), the same in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ferry.session import configure

# Word separators are the bytes 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3  # odd, 3 modulo 4
_INV_BASE = pow(_BASE, -1, 1 << 64)
MULT = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW = {"f": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["f"]) < n:
        for k, b in (("f", _BASE), ("i", _INV_BASE)):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            _POW[k] = np.multiply.accumulate(a)
    return _POW["f"][:n], _POW["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes (or one row)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    fwd, inv = _powers(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * fwd[:len(data)], out=c[1:])
    return mix((c[ends] - c[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * MULT[63])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and word offsets by row."""
    n = len(data)
    solid = ~SPACE[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = solid[:-1]
    after[:-1] = solid[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one after the other."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def in_sorted(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each value in a sorted table, and whether it is there."""
    if len(table) == 0:
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    i = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return i, table[i] == values


def give_back() -> None:
    """Freed memory of this Python worker goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def lean(run):
    """``run`` over a task's batches. Workers outlive their tasks and stand
    beside the JVM in one executor's memory, so they end a task small."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


#: Rows of an Arrow batch, and the size up to which a side measured at run time is broadcast.
BATCH_ROWS, RUNTIME_BROADCAST = "4000", "8MB"


def prepare(spark) -> None:
    """The package's session settings, and bounds for Python workers' memory."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", RUNTIME_BROADCAST)


def documents(spark, sf_dir: str, table: str = "documents"):
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
