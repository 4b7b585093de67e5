"""Text through byte chunks: wherever a payload is cut, its chunks' texts one
after the other are its text."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import chunks as ch
from ferry.plans.run import run_connection, run_scheduled, single_connection_registry
from ferry.sinks import json_loader
from ferry.sources import file_chunks as fc

PAYLOADS = [b"", b"plain", "é".encode(), "a€b".encode(), "🙂🙂".encode(), ("naïve €uro 🙂 漢字 " * 9).encode(), b"\xc3", b"ab\xe2\x82",
            b"\xf0\x9f\x99", b"\xc3(\xa9)", b"\xed\xa0\x80x", b"\xff\xfe\xfd", b"\xf0\x9fa\x99\x82", b"\xe2\x82" * 5, b"\x80" * 7,
            b"\xf4\x90\x80\x80", "é".encode() * 3]


def _messages(spark, payloads, n, edges=False):
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(payloads)], "id int, b binary")
    cut = ch.chunk_column(df, "b", n, keep=["id"], edges=edges)
    return env.build_messages(cut, F.col("data"), "s", "d", "c", F.col("id").cast("string"), F.col("seq"),
                              keep=[ch.BEFORE, ch.LAST] if edges else [])


def _texts(loaded):
    rows = loaded.select(F.col("queue").cast("int").alias("id"), "seq", "stringified_data").collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["seq"])):
        out[r["id"]] = out.get(r["id"], "") + r["stringified_data"]
    return out


def _whole(spark, payloads):
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(payloads) if p], "id int, b binary")
    return {r["id"]: r["t"] for r in df.select("id", env.stringify("b").alias("t")).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 1000])
def test_cut_anywhere(spark, n):
    expected = _whole(spark, PAYLOADS)
    for edges in (True, False):  # neighbours from the source, and by a join
        assert _texts(json_loader.prepare(_messages(spark, PAYLOADS, n, edges))) == expected


@settings(max_examples=15, deadline=None)
@given(hs.lists(hs.one_of(hs.text(max_size=12).map(lambda s: s.encode()),
                          hs.binary(max_size=12),
                          hs.lists(hs.sampled_from([0x61, 0x80, 0xBF, 0xC3, 0xE2, 0x82, 0xF0, 0x9F]), max_size=10).map(bytes)),
                min_size=1, max_size=6), hs.integers(1, 5))
def test_any_bytes(spark, payloads, n):
    if any(payloads):
        expected = _whole(spark, payloads)
        assert _texts(json_loader.prepare(_messages(spark, payloads, n, True))) == expected
        assert _texts(json_loader.prepare(_messages(spark, payloads, n))) == expected


def test_uneven_repeated_and_missing_chunks(spark):
    parts = [b"a\xf0\x9f", b"\x99", b"\x82b\xe2", b"\x82", b"\xac", b"c" * 9 + b"\xc3", b"\xa9"]
    rows = [("q", i, bytearray(p)) for i, p in enumerate(parts)]
    rows += rows[:3]  # sent twice
    rows += [("gap", 0, bytearray(b"x\xc3")), ("gap", 2, bytearray(b"\xa9y")), (None, 0, bytearray(b"\xc3")), (None, 1, bytearray(b"\xa9"))]
    df = spark.createDataFrame(rows, "q string, seq long, b binary")
    msgs = env.build_messages(df, F.col("b"), "s", "d", "c", F.col("q"), F.col("seq"))
    got = {(r["queue"], r["seq"]): r["stringified_data"] for r in json_loader.prepare(msgs).collect()}
    assert "".join(got["q", i] for i in range(7)) == "a🙂b€" + "c" * 9 + "é"
    assert (got["gap", 0], got["gap", 2]) == ("x�", "�y")  # the chunk between never came
    assert (got[None, 0], got[None, 1]) == ("", "é")


def test_sources_of_a_queue_do_not_mix(spark):
    df = spark.createDataFrame([("f1", 0, bytearray(b"x\xc3")), ("f2", 1, bytearray(b"\xa9y"))], "p string, seq long, b binary")
    msgs = env.build_messages(df, F.col("b"), F.col("p"), "d", "c", "q", F.col("seq"))
    got = {r["seq"]: r["stringified_data"] for r in json_loader.prepare(msgs).collect()}
    assert got == {0: "x�", 1: "�y"}


def test_file_edges(spark, tmp_dir):
    for name, data in (("a.txt", ("é" * 700).encode()[1:]), ("b.txt", b"ab"), ("c.txt", b"")):
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
    for n, part in ((5, 20), (1, 7), (1024, 1 << 20)):
        rows = fc.read_file_chunks(spark, tmp_dir, n, part, edges=True).collect()
        for name in ("a.txt", "b.txt"):
            with open(f"{tmp_dir}/{name}", "rb") as f:
                whole = f.read()
            own = sorted((r for r in rows if r["path"].endswith(name)), key=lambda r: r["seq"])
            assert b"".join(bytes(r["data"]) for r in own) == whole
            for r in own:
                at = r["seq"] * n
                assert bytes(r[ch.BEFORE]) == whole[max(0, at - 3):at] and r[ch.LAST] == (r is own[-1])


@pytest.mark.parametrize("extra", ["", "\U0001F642"])
def test_connection_keeps_text(spark, tmp_dir, extra):
    """A file whose character lies across the 1 MiB cut, by J1 and by J2."""
    text = "a" + "é" * 700_000 + extra
    with open(f"{tmp_dir}/f.txt", "w", encoding="utf-8") as f:
        f.write(text)
    for kind in ("manual", "scheduled"):
        out = os.path.join(tmp_dir, "out-" + kind)
        reg = single_connection_registry(spark, "c", "file_extractor", {"url": f"{tmp_dir}/f.txt"}, "json_loader", {"path": out}, kind)
        report = (run_connection(spark, "c", *reg) if kind == "manual" else run_scheduled(spark, *reg)).collect()
        assert report[0]["loaded"] == 2
        back = json_loader.read_back(spark, out).orderBy("seq").collect()
        assert "".join(r["stringified_data"] for r in back) == text
