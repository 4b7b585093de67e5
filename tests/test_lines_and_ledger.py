"""Files line by line, and files synced by a ledger of what was read."""

import os
import random

import pytest

from ferry.plans import files as fl
from ferry.plans.run import run_connection, single_connection_registry
from ferry.session import new_run_dir
from ferry.sinks import snapshot
from ferry.sources import connectors
from ferry.sources.file_lines import read_lines

CONTENTS = {"a.txt": b"", "b.txt": b"one", "c.txt": b"\n", "d.txt": b"\n\n\nx\n\n", "e.txt": "é line\r\nzwei\n\nlong ".encode() + b"y" * 200 + b"\nend",
            "f.txt": b"x" * 97 + b"\n" + b"z", "sub/g.txt": b"a\nb\nc\n"}


def _write(root, contents):
    for name, data in contents.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)


def _expected(data):
    lines = data.split(b"\n")
    return [x.removesuffix(b"\r") for x in (lines[:-1] if lines[-1] == b"" else lines)]


@pytest.mark.parametrize("range_bytes", [1, 2, 7, 50, 1 << 20])
def test_lines_of_any_ranges(spark, tmp_dir, range_bytes):
    _write(tmp_dir, CONTENTS)
    got = {}
    for r in read_lines(spark, tmp_dir, range_bytes).collect():
        got.setdefault((r["file_no"], os.path.relpath(r["path"], tmp_dir)), []).append((r["seq"], bytes(r["data"])))
    expected = {(i, name): list(enumerate(_expected(data))) for i, (name, data) in enumerate(sorted(CONTENTS.items())) if data}
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_random_lines(spark, tmp_dir):
    rng = random.Random(8)
    contents = {f"{i}.txt": bytes(rng.choice(b"ab\n\r") for _ in range(rng.randint(0, 60))) for i in range(12)}
    _write(tmp_dir, contents)
    for range_bytes in (3, 11):
        got = sorted((os.path.basename(r["path"]), r["seq"], bytes(r["data"])) for r in read_lines(spark, tmp_dir, range_bytes).collect())
        assert got == sorted((name, i, x) for name, data in contents.items() for i, x in enumerate(_expected(data)))


def test_lines_source(spark, tmp_dir):
    _write(tmp_dir, CONTENTS)
    rows = connectors.source_for("file_extractor")(spark, {"url": tmp_dir}, lines=True).collect()
    every = [x for _, data in sorted(CONTENTS.items()) for x in _expected(data)]
    assert [bytes(r["data"]) for r in sorted(rows, key=lambda r: r["seq"])] == every
    with pytest.raises(FileNotFoundError):
        read_lines(spark, tmp_dir + "/gone")


# --------------------------------------------------------------------- ledger
class Connection:
    def __init__(self, spark, root):
        self.spark, self.src, self.out = spark, f"{root}/src", new_run_dir(spark, "t-ledger")
        self.registry = single_connection_registry(spark, "c/1", "file_extractor", {"url": self.src}, "json_loader", {"path": self.out},
                                                   config={"mode": "append", "cursor": "bytes"})

    def run(self):
        return tuple(run_connection(self.spark, "c/1", *self.registry, chunk_bytes=5).first())[1:]

    def texts(self):
        out = {}
        for r in sorted(fl.read_files(self.spark, self.out, "c/1").collect(), key=lambda r: (r["metadata"]["source"], r["seq"])):
            name = os.path.relpath(r["metadata"]["source"], self.src)
            out[name] = out.get(name, "") + r["stringified_data"]
        return out


def test_only_new_files_and_appended_bytes(spark, tmp_dir):
    c = Connection(spark, tmp_dir)
    euro = "€".encode()
    _write(c.src, {"a.txt": b"hello world" + euro[:1], "b.txt": "ünïcode".encode(), "empty.txt": b""})
    assert c.run() == (5, 5, 0)
    assert c.texts() == {"a.txt": "hello world", "b.txt": "ünïcode"}
    assert c.run() == (0, 0, 0)
    _write(c.src, {"a.txt": b"hello world" + euro + b"!", "new.txt": b"123456", "empty.txt": b"x"})
    assert c.run() == (4, 4, 0)  # one chunk of the three new bytes of a.txt, two of new.txt, one of empty.txt
    assert c.texts() == {"a.txt": "hello world€!", "b.txt": "ünïcode", "new.txt": "123456", "empty.txt": "x"}
    last = {os.path.basename(r["metadata"]["source"]): r["seq"] for r in fl.read_files(spark, c.out, "c/1").where("run = 3").collect()}
    assert last["a.txt"] == 3  # numbered on


def test_truncated_and_missing_files(spark, tmp_dir):
    c = Connection(spark, tmp_dir)
    _write(c.src, {"a.txt": b"0123456789", "b.txt": b"bb", "keep.txt": b"k"})
    c.run()
    _write(c.src, {"a.txt": b"01"})
    os.remove(f"{c.src}/b.txt")
    assert c.run() == (0, 0, 1)
    assert c.texts() == {"a.txt": "0123456789", "b.txt": "bb", "keep.txt": "k"}
    found, n, bad = fl.sync_files(spark, c.src, "c/1", c.out, "l", 5)
    assert [(os.path.basename(r["path"]), r["reason"]) for r in found.collect()] == [("a.txt", fl.TRUNCATED)] and (n, bad) == (0, 1)
    _write(c.src, {"a.txt": b"0123456789AB", "b.txt": b"bbc"})  # whole again, and grown
    assert c.run() == (2, 2, 0)
    assert c.texts() == {"a.txt": "0123456789AB", "b.txt": "bbc", "keep.txt": "k"}


def test_a_ledger_run_that_died(spark, tmp_dir, monkeypatch):
    c = Connection(spark, tmp_dir)
    _write(c.src, {"a.txt": b"first"})
    real = snapshot.write_version

    def dies(*args, **kwargs):
        raise RuntimeError("lost")
    monkeypatch.setattr(snapshot, "write_version", dies)
    with pytest.raises(RuntimeError):
        c.run()
    monkeypatch.setattr(snapshot, "write_version", real)
    _write(c.src, {"a.txt": b"first and more"})
    assert c.run() == (3, 3, 0) and c.texts() == {"a.txt": "first and more"}


def test_file_strategies_are_checked(spark, tmp_dir):
    for config in ({"mode": "append", "cursor": "ts"}, {"mode": "full"}):
        reg = single_connection_registry(spark, "c", "file_extractor", {"url": tmp_dir}, "json_loader", {"path": tmp_dir + "-o"}, config=config)
        with pytest.raises(ValueError, match="bytes"):
            run_connection(spark, "c", *reg)


def test_scheduled_files_go_by_their_ledger(spark, tmp_dir):
    from ferry.plans.run import run_scheduled
    c = Connection(spark, tmp_dir)
    _write(c.src, {"a.txt": b"0123456789"})
    assert c.run() == (2, 2, 0)
    sources, loaders, conns = c.registry
    scheduled = conns.replace("manual", "scheduled", "sync_type")
    _write(c.src, {"a.txt": b"0123456789ab", "b.txt": b"b"})
    run = lambda *conns: [tuple(r) for r in run_scheduled(spark, sources, loaders, *conns, chunk_bytes=5).collect()]
    assert run(scheduled) == [("c/1", 2, None)] and c.texts() == {"a.txt": "0123456789ab", "b.txt": "b"}
    _write(c.src, {"a.txt": b"0"})
    assert run(scheduled) == [("c/1", 0, "1 files: " + fl.TRUNCATED)]
