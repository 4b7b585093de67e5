"""Text files line by line (A1 with ``lines``), numbered in their files.

Files are cut into byte ranges that are dealt over the tasks. A first pass
counts the line ends of each range; their running sum in a file is the number
of the line that a range begins in. A second pass reads each range again and
hands out the lines that start in it, the last one read to its end beyond the
range. So a file of any size is read by many tasks, and nothing but ranges
and counts is gathered for a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.plans.sizing import materialize
from ferry.sources.file_chunks import DEFAULT_PARTITION_BYTES, _fs_and_path, list_urls

BLOCK_BYTES = 4 * 1024 * 1024
LINES_SCHEMA = "path string, file_no bigint, seq bigint, data binary"


def _blocks(f, start: int, end: int):
    """The bytes from start to end, a block at a time, with each block's place."""
    at = start
    while at < end:
        block = f.read_at(min(BLOCK_BYTES, end - at), at)
        if not block:
            raise OSError("a file changed while it was read")
        yield at, block
        at += len(block)


def count_line_ends(ranges: DataFrame) -> DataFrame:
    """``ranges`` (``path, file_no, size, start, stop``) with ``ends``, the line ends in each."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            ends = []
            for r in b.to_pylist():
                filesystem, path = _fs_and_path(r["path"])
                with filesystem.open_input_file(path) as f:
                    ends.append(sum(block.count(b"\n") for _, block in _blocks(f, r["start"], r["stop"])))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.int64())], names=[*b.schema.names, "ends"])
    return ranges.mapInArrow(run, "path string, file_no bigint, size bigint, start bigint, stop bigint, ends bigint")


def _lines_of(f, start: int, stop: int, size: int):
    """(number, line) of the lines that start in the range; numbers count from
    the line that the range begins in."""
    number, open_ = 0, []
    began = start == 0 or f.read_at(1, start - 1) == b"\n"  # a line starts at the range's first byte
    for at, block in _blocks(f, start, size):
        from_ = 0
        while True:
            end = block.find(b"\n", from_)
            if end < 0:
                break
            if began:
                yield number, b"".join([*open_, block[from_:end]])
            number, began, open_, from_ = number + 1, True, [], end + 1
            if at + from_ >= stop:
                return  # the next line starts in another range
        if began:
            open_.append(block[from_:])
        elif at + len(block) >= stop:
            return  # no line starts here
    if began and any(open_):
        yield number, b"".join(open_)


def lines_of_ranges(ranges: DataFrame) -> DataFrame:
    """The lines of ranges with their first numbers (``path, file_no, size,
    start, stop, first``); a carriage return before a line's end goes with it."""
    def run(batches):
        import pyarrow as pa
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                names=["path", "file_no", "seq", "data"])
        for b in batches:
            for r in b.to_pylist():
                filesystem, path = _fs_and_path(r["path"])
                with filesystem.open_input_file(path) as f:
                    for number, line in _lines_of(f, r["start"], r["stop"], r["size"]):
                        rows.append((r["path"], r["file_no"], r["first"] + number, line.removesuffix(b"\r")))
                        held += len(line) + 64
                        if held > BLOCK_BYTES:
                            yield batch()
                            rows, held = [], 0
        if rows:
            yield batch()
    return ranges.mapInArrow(run, LINES_SCHEMA)


def _first_numbers(table):
    """The ranges of a file with the line ends before each."""
    import numpy as np
    import pyarrow as pa
    table = table.sort_by("start")
    ends = table.column("ends").to_numpy()
    return table.drop_columns(["ends"]).append_column("first", pa.array(np.cumsum(ends) - ends, pa.int64()))


def read_lines(spark: SparkSession, url: str, range_bytes: int = DEFAULT_PARTITION_BYTES) -> DataFrame:
    """``(path, file_no, seq, data)`` of the files behind ``url`` (a file,
    directory or pattern): ``seq`` is the line's number in its file from 0,
    ``file_no`` the file's place in path order. Lines end with a line feed,
    which isn't part of them; a last line without one counts, an empty file
    has none. A url that can't be listed raises ``FileNotFoundError``."""
    listing = materialize(list_urls(spark.createDataFrame([(url,)], "url string")), "listing")
    failed = listing.where(F.col("error").isNotNull()).select("error").first()
    if failed is not None:
        raise FileNotFoundError(f"{url}: {failed['error']}")
    step = F.lit(range_bytes).cast("long")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step))
    ranges = listing.where(F.col("size") > 0).select("path", "file_no", "size", start.alias("start"))
    ranges = ranges.select("*", F.least(F.col("start") + step, F.col("size")).alias("stop"))
    seen = ranges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0)).alias("bytes")).first()
    # a task for each share of DEFAULT_PARTITION_BYTES, and for each core where there is less
    tasks = max(1, -(-seen["bytes"] // DEFAULT_PARTITION_BYTES), min(spark.sparkContext.defaultParallelism, seen["n"]))
    counted = materialize(count_line_ends(ranges.repartition(tasks, "path", "start")), "line-ends")
    # a group is the counts of one file's ranges, a row for each
    first = counted.groupBy("path").applyInArrow(
        _first_numbers, "path string, file_no bigint, size bigint, start bigint, stop bigint, first bigint")
    return lines_of_ranges(first.repartition(tasks, "path", "start"))
