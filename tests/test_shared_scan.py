"""Scheduled table connections: one scan of a source for all its connections."""

import json

import pytest
from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.operators import registry as reg
from ferry.plans import shared, sync
from ferry.plans.run import read_synced, run_connection, run_scheduled
from ferry.session import new_run_dir
from ferry.sources import connectors

SCHEMA = "id long, k string, cur long, other int"
REGISTRY = "id string, name string, type string, config string"


@pytest.fixture()
def counted():
    """A registered table type; the rows that its scans give are counted in tasks."""
    made = []

    def fn(spark, config, **_):
        seen = spark.sparkContext.accumulator(0)
        df = spark.read.parquet(config["url"])

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        made.append(seen)
        return df.mapInArrow(count, df.schema)
    connectors.register_table("counted_table", fn)
    yield made
    connectors._TABLES.pop("counted_table")
    cfg.CONFIG_FIELDS.pop("counted_table")
    reg.CONNECTORS.pop("counted_table")


def _registry(spark, src, out, strategies, source_type=cfg.TABLE_READER, loader_type=cfg.TABLE_LOADER):
    sources = spark.createDataFrame([("s", "s", source_type, json.dumps({"url": src}))], REGISTRY)
    loaders = spark.createDataFrame([("l", "l", loader_type, json.dumps({"path": out}))], REGISTRY)
    conns = spark.createDataFrame([(c, ["s"], ["l"], "scheduled", None, how if how is None or isinstance(how, str) else json.dumps(how))
                                   for c, how in strategies.items()],
                                  "id string, source_id array<string>, loader_id array<string>, sync_type string, schedule string, config string")
    return sources, loaders, conns


STRATEGIES = {"all": None, "log": {"mode": "append", "cursor": "cur"}, "log/keyed": {"mode": "append", "cursor": "cur", "keys": ["id"]},
              "late": {"mode": "append", "cursor": "other"},
              "latest": {"mode": "upsert", "cursor": "cur", "keys": ["k"], "buckets": 4},
              "latest-whole": {"mode": "upsert", "cursor": "cur", "keys": ["k"], "order_by": ["cur", "id"]}}
FIRST = [(1, "a", 1, 1), (2, "b", 2, None), (3, "a", 3, 5), (4, None, None, 2)]
SECOND = [(5, "a", 3, 5), (6, "b", 9, 7), (7, "c", 4, 1), (8, "c", None, None)]  # id 5 ties the stored cursor


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_strategies_share_one_scan(spark, counted):
    src, out = new_run_dir(spark, "t-src"), new_run_dir(spark, "t-out")
    registry = _registry(spark, src, out, STRATEGIES, "counted_table")
    spark.createDataFrame(FIRST, SCHEMA).write.parquet(src)
    report = {r["connection_id"]: (r["loaded"], r["reason"]) for r in run_scheduled(spark, *registry).collect()}
    assert report == {"all": (4, None), "log": (4, None), "log/keyed": (4, None), "late": (4, None), "latest": (3, None), "latest-whole": (3, None)}
    assert [a.value for a in counted] == [len(FIRST)]  # one source, read once
    spark.createDataFrame(SECOND, SCHEMA).write.mode("append").parquet(src)
    report = {r["connection_id"]: r["loaded"] for r in run_scheduled(spark, *registry).collect()}
    assert report == {"all": 8, "log": 2, "log/keyed": 3, "late": 1, "latest": 3, "latest-whole": 3}
    assert counted[1].value == len(FIRST + SECOND)
    held = {c: _ids(read_synced(spark, out, c)) for c in STRATEGIES}
    assert held == {"all": [1, 2, 3, 4, 5, 6, 7, 8], "log": [1, 2, 3, 4, 6, 7], "log/keyed": [1, 2, 3, 4, 5, 6, 7],
                    "late": [1, 2, 3, 4, 6], "latest": held["latest"], "latest-whole": [4, 5, 6, 7]}
    assert len(held["latest"]) == 4 and {4, 6, 7} < set(held["latest"])
    report = {r["connection_id"]: r["loaded"] for r in run_scheduled(spark, *registry).collect()}  # nothing new
    assert report["log"] == report["log/keyed"] == report["late"] == 0 and report["all"] == 8
    assert {c: _ids(read_synced(spark, out, c)) for c in STRATEGIES if c != "latest"} == {c: v for c, v in held.items() if c != "latest"}


def test_scheduled_run_goes_on_from_manual_ones(spark):
    src, out = new_run_dir(spark, "t-src"), new_run_dir(spark, "t-out")
    registry = _registry(spark, src, out, {"log": STRATEGIES["log"], "latest-whole": STRATEGIES["latest-whole"]})
    spark.createDataFrame(FIRST, SCHEMA).write.parquet(src)
    for c in ("log", "latest-whole"):
        run_connection(spark, c, *registry)
    spark.createDataFrame(SECOND, SCHEMA).write.mode("append").parquet(src)
    run_scheduled(spark, *registry)
    assert _ids(read_synced(spark, out, "log")) == [1, 2, 3, 4, 6, 7]
    assert _ids(read_synced(spark, out, "latest-whole")) == [4, 5, 6, 7]
    run_connection(spark, "log", *registry)
    assert sync.connection_state(spark, f"{out}/state", "log")["runs"] == 3


def test_lowest_cursor_reaches_the_scan(spark):
    src = new_run_dir(spark, "t-src")
    spark.createDataFrame(FIRST + SECOND, SCHEMA).write.parquet(src)
    df = spark.read.parquet(src)
    prior = lambda cursor: {"rows_read": 4, "cursor": cursor, "runs": 1, "buckets": None}
    wanted = [shared.Wanted(c, {"mode": "append", "cursor": "cur"}, "t", "s", prior(at), df.schema) for c, at in (("x", "10"), ("y", "9"), ("z", "3"))]
    rows = shared.staged(df, wanted)
    plan = rows._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(cur,3)" in plan
    assert sorted((r["id"], r[shared.CONNECTION_COL]) for r in rows.collect()) == [(6, "z"), (7, "z")]
    rows = shared.staged(df, [*wanted, shared.Wanted("all", {"mode": "full"}, "t", "s", None, df.schema)])
    assert rows.where(F.col(shared.CONNECTION_COL) == "all").count() == 8 and "GreaterThanOrEqual" not in rows._jdf.queryExecution().toString()


def test_a_run_that_died_is_run_again(spark, monkeypatch):
    src, out = new_run_dir(spark, "t-src"), new_run_dir(spark, "t-out")
    registry = _registry(spark, src, out, {c: STRATEGIES[c] for c in ("all", "log", "latest-whole")})
    spark.createDataFrame(FIRST, SCHEMA).write.parquet(src)
    real, calls = sync.commit, []

    def dies(*args):
        calls.append(args[1])
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)
    monkeypatch.setattr(sync, "commit", dies)
    with pytest.raises(RuntimeError):
        run_scheduled(spark, *registry)
    monkeypatch.setattr(sync, "commit", real)
    report = {r["connection_id"]: r["loaded"] for r in run_scheduled(spark, *registry).collect()}
    assert report[calls[0]] in (0, 3, 4)
    assert _ids(read_synced(spark, out, "all")) == _ids(read_synced(spark, out, "log")) == [1, 2, 3, 4]
    assert _ids(read_synced(spark, out, "latest-whole")) == [2, 3, 4]


def test_reasons(spark):
    src, out = new_run_dir(spark, "t-src"), new_run_dir(spark, "t-out")
    spark.createDataFrame(FIRST, SCHEMA).write.parquet(src)
    bad = {"no-column": {"mode": "append", "cursor": "nowhere"}, "no-mode": {"mode": "sideways"}, "not-json": "{", "good": {"mode": "append", "cursor": "cur"},
           "no-keys": {"mode": "upsert", "cursor": "cur"}}
    report = {r["connection_id"]: (r["loaded"], r["reason"]) for r in run_scheduled(spark, *_registry(spark, src, out, bad)).collect()}
    assert report.pop("good") == (4, None)
    assert all(n is None and reason for n, reason in report.values()) and "nowhere" in report["no-column"][1]
    gone = run_scheduled(spark, *_registry(spark, src + "-gone", out, {"c": None})).collect()
    assert [tuple(r) for r in gone] == [("c", None, "source not found")]
    for source_type, loader_type in ((cfg.TABLE_READER, cfg.JSON_LOADER), (cfg.FILE_EXTRACTOR, cfg.TABLE_LOADER)):
        got = run_scheduled(spark, *_registry(spark, src, out, {"c": None}, source_type, loader_type)).collect()
        assert got[0]["loaded"] is None and "not" in got[0]["reason"]


def test_pages_by_prefix_alike(spark):
    """The same connections load the same pages by J1 and by J2."""
    pages = spark.createDataFrame([(1, "https://a.org/x", "é" * 5), (2, "https://a.org/", "b"), (3, "http://a.org/", "c"), (4, "https://b.org", ""), (5, None, "n")],
                                  "page_id long, url string, html string")
    urls = {"exact": "https://a.org/x", "site": "https://a.org", "all": "http", "none": "ftp:", "same": "http"}
    sources = spark.createDataFrame([(k, k, cfg.WEB_SCRAPER, json.dumps({"url": u})) for k, u in urls.items()], REGISTRY)

    def loaded(kind, run):
        from ferry.sinks import json_loader
        out = new_run_dir(spark, "t-pages")
        loaders = spark.createDataFrame([("l", "l", cfg.JSON_LOADER, json.dumps({"path": out}))], REGISTRY)
        conns = spark.createDataFrame([(k, [k], ["l"], kind) for k in urls], "id string, source_id array<string>, loader_id array<string>, sync_type string")
        run(sources, loaders, conns)
        return sorted((r["connection_id"], r["seq"], r["stringified_data"]) for r in json_loader.read_back(spark, out).collect())
    by_hand = loaded("manual", lambda *reg: [run_connection(spark, k, *reg, pages=pages, chunk_bytes=3) for k in urls])
    together = loaded("scheduled", lambda *reg: run_scheduled(spark, *reg, chunk_bytes=3, pages=pages))
    assert by_hand == together and {c for c, *_ in together} == {"exact", "site", "all", "same"}
