"""File source (A1): files as fixed-size byte chunks, as a Spark data source.

``spark.read.format("file_chunks").option("path", '["p"]').load()`` gives rows
``(path, seq, data)``: ``seq`` numbers the chunks of a file from 0, the last
chunk is short, an empty file gives no row. Files are listed on the driver
(names and sizes only); each input partition is a list of byte ranges of
about ``partition_bytes`` and is read by one task with ranged reads, so no
file is ever held whole in memory and a large file spreads over many tasks.
Paths go through ``pyarrow.fs`` so executors open local, HDFS or object
store paths alike.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ferry.functions.envelope import EDGE_BYTES
from ferry.operators.chunks import BEFORE, DEFAULT_CHUNK_BYTES, LAST

DEFAULT_PARTITION_BYTES = 128 * 1024 * 1024
#: Bytes of a range that is dealt to a task, and of an Arrow batch, all of which one read fills.
RANGE_BYTES, BATCH_BYTES = 16 * 1024 * 1024, 4 * 1024 * 1024
#: A row counts as so many bytes at least: it has a path too.
ROW_BYTES = 256
#: Rows of a listing handed on together.
LISTED_ROWS = 10_000
SCHEMA = "path string, seq bigint, data binary"
EDGES_SCHEMA = f"{SCHEMA}, {BEFORE} binary, {LAST} boolean"


@dataclass
class _Range:
    path: str
    first_seq: int
    last_seq: int  # inclusive
    size: int
    base: int = 0  # added to the chunk numbers that are handed out
    start: int = 0  # byte that chunk 0 begins with


class ChunkPartition(InputPartition):
    def __init__(self, ranges: list[_Range]):
        super().__init__(ranges)
        self.ranges = ranges


def _fs_and_path(uri: str):
    from pyarrow import fs
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")  # file:/a as Hadoop writes it


def list_files(uri: str) -> list[tuple[str, int]]:
    """(path, size) of a file, of the files below a directory (hidden
    ``_``/``.`` names skipped), or of the files a ``*`` pattern matches in
    its directory. Sorted by path."""
    import fnmatch
    from pyarrow import fs
    filesystem, path = _fs_and_path(uri)
    scheme = uri.split("://", 1)[0] + "://" if "://" in uri else ""
    pattern = None
    if "*" in path.rsplit("/", 1)[-1]:
        path, pattern = path.rsplit("/", 1)
    info = filesystem.get_file_info(path)
    if info.type == fs.FileType.File:
        found = [info]
    elif info.type == fs.FileType.Directory:
        found = filesystem.get_file_info(fs.FileSelector(path, recursive=pattern is None))
    else:
        raise FileNotFoundError(uri)
    out = []
    for f in found:
        if f.type != fs.FileType.File:
            continue
        name = f.path.rsplit("/", 1)[-1]
        rel = f.path[len(path):]
        if any(part.startswith(("_", ".")) for part in rel.split("/") if part):
            continue
        if pattern and not fnmatch.fnmatch(name, pattern):
            continue
        out.append((scheme + f.path if scheme and "://" not in f.path else f.path, f.size))
    return sorted(out)


def plan_ranges(files: list[tuple[str, int]], chunk_bytes: int, partition_bytes: int,
                continuous: bool = False) -> list[list[_Range]]:
    """Group chunk ranges into partitions of about ``partition_bytes``.
    ``continuous`` numbers the chunks through the whole file list."""
    per_part = max(1, partition_bytes // chunk_bytes)
    parts: list[list[_Range]] = []
    cur: list[_Range] = []
    room = per_part
    base = 0
    for path, size in files:
        n = (size + chunk_bytes - 1) // chunk_bytes
        seq = 0
        while seq < n:
            take = min(room, n - seq)
            cur.append(_Range(path, seq, seq + take - 1, size, base))
            seq += take
            room -= take
            if room == 0:
                parts.append(cur)
                cur, room = [], per_part
        if continuous:
            base += n
    if cur:
        parts.append(cur)
    return parts


class FileChunksReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.chunk_bytes = int(options.get("chunk_bytes", DEFAULT_CHUNK_BYTES))
        self.partition_bytes = int(options.get("partition_bytes", DEFAULT_PARTITION_BYTES))
        self.parallelism = int(options.get("parallelism", 1))
        self.continuous = options.get("continuous", "false") == "true"
        self.edges = options.get("edges", "false") == "true"
        if self.chunk_bytes <= 0:
            raise ValueError("chunk_bytes must be positive")

    def partitions(self):
        files = []
        for p in json.loads(self.path):
            files.extend(list_files(p))
        # Like Spark's own file splits: at most partition_bytes per task, but
        # small inputs are spread so every core gets a share.
        total = sum(size for _, size in files)
        per_core = -(-total // max(1, self.parallelism))
        split = min(self.partition_bytes, max(self.chunk_bytes, per_core))
        return [ChunkPartition(r) for r in plan_ranges(files, self.chunk_bytes, split, self.continuous)]

    def read(self, partition: ChunkPartition):
        yield from read_ranges(partition.ranges, self.chunk_bytes, self.edges)


def read_ranges(ranges, n: int, edges: bool = False):
    """Ranged reads, handed to Spark as Arrow record batches of about
    ``BATCH_BYTES`` (a chunk where that is longer). A read's buffer is the
    column's data, so neither rows nor chunks are objects in Python. ``edges``:
    each read begins a few bytes earlier, for the bytes before the first chunk."""
    import pyarrow as pa
    per_batch = max(1, BATCH_BYTES // max(n, ROW_BYTES))
    parts, held = [], 0
    try:
        for r in ranges:
            filesystem, path = _fs_and_path(r.path)
            with filesystem.open_input_file(path) as f:
                seq = r.first_seq
                while seq <= r.last_seq:  # one ranged read for as many chunks as the batch takes
                    count = min(per_batch - held, r.last_seq - seq + 1)
                    parts.append(_chunks(pa, f, r, seq, count, n, edges))
                    seq, held = seq + count, held + count
                    if held >= per_batch:
                        yield _batch(pa, parts)
                        parts, held = [], 0
        if parts:
            yield _batch(pa, parts)
    finally:  # a worker outlives its task
        parts = None
        pa.default_memory_pool().release_unused()


def _chunks(pa, f, r: _Range, seq: int, count: int, n: int, edges: bool):
    """The batch of ``count`` chunks from ``seq`` on, by one read."""
    import numpy as np
    start = r.start + seq * n
    front = min(EDGE_BYTES, start) if edges else 0
    want = min(count * n, r.size - start)
    f.seek(start - front)
    block = f.read_buffer(want + front)
    if block.size != want + front:
        raise OSError(f"{r.path} changed while it was read")
    at = np.arange(count, dtype=np.int64)
    columns = [pa.repeat(pa.scalar(r.path, pa.string()), count), pa.array(at + (r.base + seq)),
               _binary(pa, np.append(at * n, want), block.slice(front))]
    if edges:
        near = front + (at * n)[:, None] + np.arange(-EDGE_BYTES, 0)
        there = near >= 0
        before = np.frombuffer(block, np.uint8)[near[there]]
        columns += [_binary(pa, np.append(0, np.cumsum(there.sum(1))), pa.py_buffer(before)), pa.array(start + (at + 1) * n >= r.size)]
    return pa.RecordBatch.from_arrays(columns, names=["path", "seq", "data", BEFORE, LAST][:len(columns)])


def _binary(pa, offsets, data):
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("int32")), data])


def _batch(pa, parts: list):
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class FileChunks(DataSource):
    """Options: ``path`` (a JSON list of files, directories, ``dir/*.ext``),
    ``chunk_bytes`` (default 1 MiB), ``partition_bytes`` (default 128 MiB),
    ``parallelism`` (cores to spread a small input over), ``continuous``
    (``true``: one numbering through all files, in path order), ``edges``
    (``true``: also the bytes before a chunk and whether it ends its file)."""

    @classmethod
    def name(cls):
        return "file_chunks"

    def schema(self):
        return EDGES_SCHEMA if self.options.get("edges", "false") == "true" else SCHEMA

    def reader(self, schema):
        return FileChunksReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(FileChunks)


def read_file_chunks(spark, path: str | list[str], chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                     partition_bytes: int = DEFAULT_PARTITION_BYTES, continuous: bool = False, edges: bool = False):
    register(spark)
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.format("file_chunks").option("path", json.dumps(paths))
            .option("chunk_bytes", str(chunk_bytes))
            .option("partition_bytes", str(partition_bytes))
            .option("continuous", str(continuous).lower())
            .option("edges", str(edges).lower())
            .option("parallelism", str(spark.sparkContext.defaultParallelism)).load())


def list_urls(urls, chunk_bytes: int = DEFAULT_CHUNK_BYTES):
    """The files behind each distinct ``url``, listed in tasks: ``(url, path,
    size, first_seq, error, file_no)``. ``first_seq`` numbers a url's chunks
    through its files in path order, ``file_no`` the files; a url that cannot be listed is one row with a
    null path and an ``error``."""
    def listed(batches):
        import pyarrow as pa
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["url", "path", "size", "first_seq", "error", "file_no"])
        rows = []
        for b in batches:
            for url in b.column(0).to_pylist():
                try:
                    first = 0
                    for i, (path, size) in enumerate(list_files(url)):
                        rows.append((url, path, size, first, None, i))
                        first += -(-size // chunk_bytes)
                        if len(rows) == LISTED_ROWS:
                            yield batch(rows)
                            rows = []
                except FileNotFoundError:
                    rows.append((url, None, 0, 0, "source not found", 0))
                except (OSError, ValueError) as e:
                    rows.append((url, None, 0, 0, f"source not readable: {e}", 0))
        if rows:
            yield batch(rows)
    return urls.select("url").distinct().mapInArrow(
        listed, "url string, path string, size bigint, first_seq bigint, error string, file_no bigint")


def read_listed(files, chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                partition_bytes: int = DEFAULT_PARTITION_BYTES, edges: bool = False):
    """The chunks ``(path, seq, data)`` (with ``edges`` as in ``FileChunks``)
    of a table ``(path, size)`` of distinct files: ranges of about 16 MiB are
    dealt over the tasks, about ``partition_bytes`` each; only their total size
    comes to the driver. With ``start`` and ``base`` in the table, a file is
    read from that byte on and its chunks are numbered from there."""
    from pyspark.sql import functions as F
    spark = files.sparkSession
    for extra in ("start", "base"):
        if extra not in files.columns:
            files = files.withColumn(extra, F.lit(0).cast("long"))
    total = files.agg(F.sum(F.col("size") - F.col("start"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    tasks = max(-(-total // partition_bytes), min(cores, -(-total // chunk_bytes)), 1)
    step = max(1, min(RANGE_BYTES, -(-total // tasks)) // chunk_bytes)
    last = F.expr(f"(size - start + {chunk_bytes} - 1) div {chunk_bytes} - 1")
    ranges = (files.where(F.col("size") > F.col("start"))
              .select("path", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(step).cast("long")))
                      .alias("first_seq"), last.alias("_last"), "size", "start", "base")
              .select("path", "first_seq",
                      F.least(F.col("first_seq") + F.lit(step - 1), F.col("_last")).alias("last_seq"), "size", "base", "start"))

    def read(batches):
        for batch in batches:
            yield from read_ranges([_Range(**r) for r in batch.to_pylist()], chunk_bytes, edges)
    return ranges.repartition(tasks).mapInArrow(read, EDGES_SCHEMA if edges else SCHEMA)
