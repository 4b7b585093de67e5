"""Files that queries write and read: as many as their bytes ask for."""

import glob
import os
import random
import tracemalloc

import pytest

from ferry.plans import catalog
from ferry.session import local_path, scratch_root
from ferry.sources import file_chunks as fc


def _files(spark):
    return set(glob.glob(f"{local_path(scratch_root(spark))}/ferry/file-lines-*/part-*"))


@pytest.mark.parametrize("ids", [range(300), [7 * i + i % 3 for i in range(299)] + [None], [5, 5, 5, 9]])
def test_line_files_grow_in_number(spark, tmp_dir, monkeypatch, ids):
    monkeypatch.setattr(catalog, "LINE_FILE_BYTES", 1000, raising=False)
    monkeypatch.setattr(catalog, "LINE_RANGE_BYTES", 300)
    rows = [(i, f"text é {i}\n" + "x" * (j % 90)) for j, i in enumerate(ids)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_dir}/documents.parquet")
    had = _files(spark)
    got = sorted((tuple(r) for r in catalog.file_lines(spark, tmp_dir).collect()), key=repr)
    n = [os.path.getsize(f) for f in _files(spark) - had]
    # a line is the row's place in the order of doc_id (null last), numbered from the smallest id
    ids = sorted(ids, key=lambda i: (i is None, i))
    assert sorted(r[0] for r in got) == [ids[0] + k for k in range(len(ids))]
    assert sorted((r[1:] for r in got), key=repr) == sorted(rows, key=repr)
    assert [r[1] for r in sorted(got)] == ids
    if len(ids) > 100:  # four files of a quarter of all bytes before
        assert len(n) > 10 and max(n) < sum(n) / 8


def test_no_documents(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert catalog.file_lines(spark, tmp_dir).count() == 0


def test_ranges_are_read_in_small_batches(tmp_dir):
    size, n = 40 << 20, 1000
    with open(f"{tmp_dir}/a", "wb") as f:
        f.write(os.urandom(1 << 20) * 40)
    list(fc.read_ranges([fc._Range(f"{tmp_dir}/a", 0, 9, size)], n, True))
    tracemalloc.start()
    biggest = rows = 0
    for batch in fc.read_ranges([fc._Range(f"{tmp_dir}/a", 0, -(-size // n) - 1, size)], n, True):
        biggest, rows = max(biggest, batch.nbytes), rows + batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == -(-size // n)
    assert biggest < 6 << 20 and peak < 6 << 20  # a batch of 16 MiB and its chunks as objects before


@pytest.mark.parametrize("edges", [False, True])
@pytest.mark.parametrize("n", [1, 2, 5, 64])
def test_ranges_of_several_files(tmp_dir, monkeypatch, n, edges):
    monkeypatch.setattr(fc, "BATCH_BYTES", 7 * 64)
    monkeypatch.setattr(fc, "ROW_BYTES", 16, raising=False)
    rng = random.Random(n)
    ranges, expected = [], []
    for k in range(9):
        path, data = f"{tmp_dir}/{k}", rng.randbytes(rng.randint(1, 300))
        with open(path, "wb") as f:
            f.write(data)
        start, base = rng.choice([0, rng.randrange(len(data))]), rng.choice([0, 100])
        last = -(-(len(data) - start) // n) - 1
        first = rng.randint(0, last)
        ranges.append(fc._Range(path, first, last, len(data), base, start))
        for s in range(first, last + 1):
            a = start + s * n
            row = (path, base + s, data[a:a + n])
            expected.append(row + ((data[max(0, a - 3):a], a + n >= len(data)) if edges else ()))
    batches = list(fc.read_ranges(ranges, n, edges))
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == expected
    assert max(b.num_rows for b in batches) <= max(1, 7 * 64 // max(n, 16))


def test_a_long_listing_in_parts(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(fc, "LISTED_ROWS", 3, raising=False)
    for k in range(8):
        with open(f"{tmp_dir}/{k}", "wb") as f:
            f.write(b"x" * (5 * k))
    urls = spark.createDataFrame([(tmp_dir,), (f"{tmp_dir}/3",), (f"{tmp_dir}/gone",)], "url string")
    got = sorted((tuple(r) for r in fc.list_urls(urls, 10).collect()), key=repr)
    rows, first = [], 0
    for k in range(8):
        rows.append((tmp_dir, f"{tmp_dir}/{k}", 5 * k, first, None, k))
        first += -(-5 * k // 10)
    rows += [(f"{tmp_dir}/3", f"{tmp_dir}/3", 15, 0, None, 0), (f"{tmp_dir}/gone", None, 0, 0, "source not found", 0)]
    assert got == sorted(rows, key=repr)
