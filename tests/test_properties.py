"""Property checks with generated inputs (kept to few examples: each one is
a Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import chunks as ch
from ferry.operators import queue as q
from ferry.operators import strategies as st

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(payloads=hs.lists(hs.binary(max_size=300), min_size=1, max_size=6),
       n=hs.integers(min_value=1, max_value=64))
def test_chunk_json_reassemble_round_trip(spark, payloads, n):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id long, p binary")
    chunks = ch.chunk_column(df, "p", n, keep=["id"])
    msgs = env.build_messages(chunks, data=F.col("data"), source="s", destination="d",
                              connection_id="c", queue=F.col("id").cast("string"), seq=F.col("seq"))
    back = q.good(q.parse_messages(msgs.select(env.serialize().alias("value"))))
    got = {int(r["queue"]): (bytes(r["data"]), r["complete"]) for r in ch.reassemble(back, ["queue"]).collect()}
    want = {i: (p, True) for i, p in enumerate(payloads) if p}
    assert got == want


@SETTINGS
@given(rows=hs.lists(hs.tuples(hs.sampled_from(["a", "b", None]),
                               hs.one_of(hs.none(), hs.integers(-5, 5)),
                               hs.integers(0, 1000)), min_size=1, max_size=30, unique_by=lambda t: t[2]))
def test_dedup_latest_matches_sorting(spark, rows):
    df = spark.createDataFrame(rows, "k string, cur long, tie long")
    got = {r["k"]: (r["cur"], r["tie"]) for r in st.dedup_latest(df, ["k"], ["cur", "tie"]).collect()}
    want = {}
    for k, cur, tie in rows:
        best = want.get(k)
        key = (cur is not None, cur if cur is not None else 0, tie)
        if best is None or key > (best[0] is not None, best[0] if best[0] is not None else 0, best[1]):
            want[k] = (cur, tie)
    assert got == want


@SETTINGS
@given(rows=hs.lists(hs.tuples(hs.sampled_from(["q1", "q2", "q3"]), hs.booleans()),
                     min_size=1, max_size=40))
def test_until_end_matches_sequential_reading(spark, rows):
    data = [(qn, i, end) for i, (qn, end) in enumerate(rows)]
    df = spark.createDataFrame(data, "queue string, seq long, IsEnd boolean")
    got = sorted((r["queue"], r["seq"]) for r in q.until_end(df).collect())
    want, ended = [], set()
    for qn, i, end in data:  # a consumer reading each queue in seq order
        if qn in ended:
            continue
        if end:
            ended.add(qn)
        else:
            want.append((qn, i))
    assert got == sorted(want)


@SETTINGS
@given(rows=hs.lists(hs.tuples(hs.sampled_from(["x", "y"]), hs.one_of(hs.none(), hs.integers(0, 50))),
                     min_size=1, max_size=30),
       cut=hs.integers(0, 50))
def test_sync_state_fold_equals_whole(spark, rows, cut):
    df = spark.createDataFrame(rows, "g string, cur long")
    first = df.where(f"cur < {cut}")
    rest = df.where(f"not (cur < {cut}) or cur is null")
    folded = st.sync_state(rest, ["g"], "cur", prior=st.sync_state(first, ["g"], "cur"))
    whole = st.sync_state(df, ["g"], "cur")
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, whole.collect()))


@SETTINGS
@given(rows=hs.lists(hs.tuples(hs.integers(0, 10_000), hs.sampled_from(["a", "b", "é", None])),
                     min_size=1, max_size=25, unique_by=lambda t: t[0]))
def test_dedup_exact_keeps_smallest_id_per_payload(spark, rows):
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted(tuple(r) for r in st.dedup_exact(df, "t", "id").collect())
    best = {}
    for i, t in rows:
        best[t] = min(i, best.get(t, i))
    assert got == sorted((i, t) for t, i in best.items())
