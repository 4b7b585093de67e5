import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import queue as q

T0 = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


def _messages(spark, payloads):
    rows = [(i, p) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "i long, p binary")
    return env.build_messages(df, data=F.col("p"), source="src", destination="dst",
                              connection_id="c", queue="q", seq=F.col("i"),
                              created_at=F.lit(T0), keep=["i"])


def test_serialize_keys_order_and_formats(spark):
    line = _messages(spark, [b"\x00\xff<x>&\xc3\xa9"]).select(env.serialize().alias("v")).first()["v"]
    obj = json.loads(line)
    assert list(obj) == env.ROUTING_KEYS + env.ENVELOPE_KEYS
    assert list(obj["metadata"]) == ["source", "destination"]
    assert base64.b64decode(obj["data"]) == b"\x00\xff<x>&\xc3\xa9"
    assert obj["created_at"] == "2024-01-02T03:04:05.123456Z"
    assert obj["updated_at"] == obj["created_at"]
    assert obj["stringified_data"] == "" and obj["IsEnd"] is False


def test_long_payload_base64_has_no_line_breaks(spark):
    line = _messages(spark, [bytes(range(256)) * 4]).select(env.serialize().alias("v")).first()["v"]
    assert "\\n" not in line and "\\r" not in line
    b64 = spark.createDataFrame([(bytes(range(256)) * 4,)], "b binary") \
        .select(env.base64_payload("b").alias("x")).first()["x"]
    assert "\n" not in b64 and base64.b64decode(b64) == bytes(range(256)) * 4


def test_round_trip_bytes_and_times(spark):
    payloads = [b"", b"a", "é\n\"'".encode(), bytes(range(256))]
    msgs = _messages(spark, payloads)
    back = q.good(q.parse_messages(msgs.select("i", env.serialize().alias("value")), keep=["i"]))
    got = {r["i"]: r for r in back.collect()}
    for i, p in enumerate(payloads):
        assert bytes(got[i]["data"]) == p
        assert got[i]["created_at"] == T0
        assert got[i]["metadata"]["source"] == "src"
        assert got[i]["IsEnd"] is False


def test_parse_edge_rows(spark):
    lines = ['{"IsEnd": true}', '{}', '{"k": 1}', "null", "[]", "1", "bad", "", '{"IsEnd":"x"}',
             '{"isend": true}', None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i long, value string")
    parsed = {r["i"]: r for r in q.parse_messages(df, keep=["i"]).collect()}
    good = {i for i, r in parsed.items() if r["_reject"] is None}
    # valid objects are messages; unknown keys are ignored; keys are exact-case
    assert good == {0, 1, 2, 9}
    assert parsed[0]["IsEnd"] is True
    assert parsed[9]["IsEnd"] is None  # 'isend' is not 'IsEnd'
    assert parsed[10]["_reject"] == "null message"
    for i in (3, 4, 5, 6, 7, 8):
        assert parsed[i]["_reject"] == "malformed message"
    # loaded + quarantined = input
    assert q.good(q.parse_messages(df)).count() + q.rejects(q.parse_messages(df)).count() == len(lines)


def test_missing_isend_reads_false(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    assert q.good(q.parse_messages(df)).first()["IsEnd"] is False


def test_stringify_invalid_utf8(spark):
    df = spark.createDataFrame([(bytes([0x61, 0xE2, 0x82]),), ("é".encode(),)], "b binary")
    out = [r["s"] for r in df.select(env.stringify("b").alias("s")).collect()]
    assert out[0].encode() == bytes([0x61, 0xEF, 0xBF, 0xBD])
    assert out[1] == "é"


def test_end_marker_shape(spark):
    m = spark.range(1).select(*env.end_marker(F.lit("c"), F.lit("q"), F.lit(9))).first()
    assert m["IsEnd"] is True and m["data"] is None and m["seq"] == 9


def test_strict_parse_rejects_trailing_text(spark):
    lines = ['{"IsEnd": true} x', '{"seq": 1}{"seq": 2}', '{"seq": 3}', "[]"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i long, value string")
    lax = {r["i"] for r in q.good(q.parse_messages(df, keep=["i"])).collect()}
    strict = {r["i"] for r in q.good(q.parse_messages(df, keep=["i"], strict=True)).collect()}
    assert lax == {0, 1, 2}  # Spark's reader stops after the first object
    assert strict == {2}
