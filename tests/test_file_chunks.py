import os

from ferry.sources import file_chunks as fc


def _write(d, name, data):
    p = os.path.join(d, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_file_sizes_and_round_trip(spark, tmp_dir):
    n = 8
    files = {"empty.bin": b"", "one.bin": b"x", "exact.bin": b"a" * (2 * n),
             "long.bin": bytes(range(256)) * 3 + "é".encode()}
    for k, v in files.items():
        _write(tmp_dir, k, v)
    _write(tmp_dir, "_hidden.bin", b"nope")
    df = fc.read_file_chunks(spark, tmp_dir, chunk_bytes=n, partition_bytes=3 * n)
    rows = df.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r["path"]), []).append((r["seq"], bytes(r["data"])))
    assert "empty.bin" not in by_file and "_hidden.bin" not in by_file
    for name, data in files.items():
        if not data:
            continue
        parts = sorted(by_file[name])
        assert [s for s, _ in parts] == list(range(len(parts)))
        assert all(len(d) == n for _, d in parts[:-1]) and 0 < len(parts[-1][1]) <= n
        assert b"".join(d for _, d in parts) == data
    # many small partitions: ranges of one file spread over several tasks
    assert df.rdd.getNumPartitions() > 1


def test_glob_and_single_file(spark, tmp_dir):
    _write(tmp_dir, "a.txt", b"hello")
    _write(tmp_dir, "b.dat", b"world")
    got = fc.read_file_chunks(spark, os.path.join(tmp_dir, "*.txt"), chunk_bytes=2).collect()
    assert sorted(bytes(r["data"]) for r in got) == [b"he", b"ll", b"o"]
    one = fc.read_file_chunks(spark, os.path.join(tmp_dir, "b.dat"), chunk_bytes=100).collect()
    assert [bytes(r["data"]) for r in one] == [b"world"]


def test_plan_ranges_groups_chunks():
    parts = fc.plan_ranges([("a", 10), ("b", 25)], chunk_bytes=5, partition_bytes=15)
    flat = [(r.path, r.first_seq, r.last_seq) for p in parts for r in p]
    assert flat == [("a", 0, 1), ("b", 0, 0), ("b", 1, 3), ("b", 4, 4)]
    assert all(sum(r.last_seq - r.first_seq + 1 for r in p) <= 3 for p in parts)


def test_lines_option(spark, tmp_dir):
    from ferry.sources import connectors
    p = _write(tmp_dir, "t.txt", "alpha\nbeta é\n\ngamma".encode())
    rows = connectors.source_for("file_extractor")(spark, {"url": p}, lines=True).collect()
    rows = sorted(rows, key=lambda r: r["seq"])
    assert [bytes(r["data"]).decode() for r in rows] == ["alpha", "beta é", "", "gamma"]
