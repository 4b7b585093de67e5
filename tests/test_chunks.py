import pytest
from pyspark.sql import types as T

from ferry.operators import chunks as ch

N = 4


def _chunks(spark, payloads, n=N):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id long, p binary")
    return ch.chunk_column(df, "p", n, keep=["id"])


def test_sizes_around_the_chunk_size(spark):
    payloads = [b"", b"x", b"a" * (N - 1), b"b" * N, b"c" * (N + 1), b"d" * (2 * N)]
    rows = _chunks(spark, payloads).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["id"], []).append((r["seq"], bytes(r["data"])))
    assert 0 not in by_id  # empty payload: no chunk
    assert [len(d) for _, d in sorted(by_id[1])] == [1]
    assert [len(d) for _, d in sorted(by_id[2])] == [N - 1]
    assert [len(d) for _, d in sorted(by_id[3])] == [N]
    assert [len(d) for _, d in sorted(by_id[4])] == [N, 1]
    assert [len(d) for _, d in sorted(by_id[5])] == [N, N]
    for i, p in enumerate(payloads[1:], start=1):
        assert b"".join(d for _, d in sorted(by_id[i])) == p


def test_null_payload_gives_no_chunk(spark):
    df = spark.createDataFrame([(1, None)], "id long, p binary")
    assert ch.chunk_column(df, "p", 4, keep=["id"]).count() == 0


def test_text_is_cut_on_utf8_bytes(spark):
    df = spark.createDataFrame([(1, "aé")], "id long, t string")  # 61 C3 A9
    rows = sorted(ch.chunk_column(df, "t", 2, keep=["id"]).collect(), key=lambda r: r["seq"])
    assert [bytes(r["data"]) for r in rows] == [b"a\xc3", b"\xa9"]


@pytest.mark.parametrize("n", [1, 7, 1024, 1024 * 1024])
def test_round_trip_chunk_sizes(spark, n):
    payloads = [("héllo wörld " * 500).encode(), bytes(range(256)) * 9, b"z"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id long, p binary")
    whole = ch.reassemble(ch.chunk_column(df, "p", n, keep=["id"]), ["id"])
    got = {r["id"]: (bytes(r["data"]), r["n_chunks"]) for r in whole.collect()}
    for i, p in enumerate(payloads):
        assert got[i][0] == p
        assert got[i][1] == -(-len(p) // n)


def test_bad_chunk_size(spark):
    df = spark.createDataFrame([(1, b"x")], "id long, p binary")
    with pytest.raises(ValueError):
        ch.chunk_column(df, "p", 0)


def test_chunking_has_no_shuffle(spark):
    df = spark.createDataFrame([(1, b"x" * 10)], "id long, p binary")
    plan = ch.chunk_column(df, "p", 3, keep=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_map_chunks_quarantines_failures(spark):
    df = spark.createDataFrame([(1, "aé"), (2, "ok")], "id long, t string")
    chunks = ch.chunk_column(df, "t", 2, keep=["id"])
    out = ch.map_chunks(chunks, lambda b: len(b.decode("utf-8")), T.LongType(), keys=["id", "seq"])
    rows = {(r["id"], r["seq"]): r for r in out.collect()}
    assert rows[(2, 0)]["result"] == 2 and rows[(2, 0)]["error"] is None
    assert rows[(1, 0)]["result"] is None and "UnicodeDecodeError" in rows[(1, 0)]["error"]
    assert ch.accepted(out).count() + ch.quarantined(out).count() == chunks.count()


@pytest.mark.parametrize("n", [1, 7, 1024, 1024 * 1024])
def test_round_trip_through_json_hop(spark, n):
    from pyspark.sql import functions as F

    from ferry.functions import envelope as env
    from ferry.operators import queue as q
    payloads = [("aé€𝄞 " * 300).encode(), bytes(range(256)) * 5]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id long, p binary")
    chunks = ch.chunk_column(df, "p", n, keep=["id"])
    msgs = env.build_messages(chunks, data=F.col("data"), source="s", destination="d",
                              connection_id="c", queue=F.col("id").cast("string"), seq=F.col("seq"))
    back = q.good(q.parse_messages(msgs.select(env.serialize().alias("value"))))
    whole = {int(r["queue"]): bytes(r["data"]) for r in ch.reassemble(back, ["queue"]).collect()}
    assert whole == dict(enumerate(payloads))


def test_reassemble_flags_gaps(spark):
    df = spark.createDataFrame([(1, 0, b"ab"), (1, 1, b"cd"), (2, 0, b"ef"), (2, 2, b"ij")],
                               "id long, seq long, data binary")
    got = {r["id"]: (bytes(r["data"]), r["complete"]) for r in ch.reassemble(df, ["id"]).collect()}
    assert got == {1: (b"abcd", True), 2: (b"efij", False)}
