import os

from pyspark.sql import functions as F

import pytest

from ferry.plans.run import run_connection, single_connection_registry
from ferry.session import new_run_dir
from ferry.sinks import json_loader


def test_run_connection_copies_a_file(spark, tmp_dir):
    data = ("line one\nzwei é\n" * 5000).encode()
    src = os.path.join(tmp_dir, "in.txt")
    with open(src, "wb") as f:
        f.write(data)
    out = new_run_dir(spark, "t-run")
    s, l_, c = single_connection_registry(spark, "c9", "file_extractor", {"url": src},
                                          "json_loader", {"path": out})
    report = run_connection(spark, "c9", s, l_, c, chunk_bytes=4096).first()
    n = -(-len(data) // 4096)
    assert (report["read"], report["loaded"], report["rejected"]) == (n, n, 0)
    back = sorted(json_loader.read_back(spark, out).collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in back] == list(range(n))
    assert back[0]["queue"] == "file_extractor_c9" and back[0]["connection_id"] == "c9"
    assert back[0]["metadata"]["source"] == src and back[0]["data"] is None


def test_run_connection_rejects_bad_config(spark):
    s, l_, c = single_connection_registry(spark, "c1", "file_extractor", {}, "json_loader", {"path": "/x"})
    with pytest.raises(ValueError, match="url is required"):
        run_connection(spark, "c1", s, l_, c)
    s, l_, c = single_connection_registry(spark, "c2", "api", {"url": "x"}, "json_loader", {"path": "/x"})
    with pytest.raises(ValueError, match="unknown config type: api"):
        run_connection(spark, "c2", s, l_, c)
    s, l_, c = single_connection_registry(spark, "c3", "file_extractor", {"url": "x"}, "json_loader",
                                          {"path": "/x"}, sync_type="hourly")
    with pytest.raises(ValueError, match="Invalid sync type"):
        run_connection(spark, "c3", s, l_, c)
    with pytest.raises(ValueError, match="not found"):
        run_connection(spark, "nope", s, l_, c)


def test_web_scraper_connector(spark):
    from ferry.sources import connectors
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    df = connectors.source_for("web_scraper")(spark, {"url": "https://"}, chunk_bytes=1 << 20, pages=pages)
    assert df.count() == pages.where("url like 'https://%'").count()


def test_run_scheduled_reads_each_source_once(spark, tmp_dir):
    import json as _json

    from ferry.plans.run import run_scheduled
    files = {}
    for name, size in (("a.bin", 10), ("b.bin", 25)):
        p = os.path.join(tmp_dir, name)
        with open(p, "wb") as f:
            f.write(bytes(range(size)))
        files[name] = p
    out1, out2 = new_run_dir(spark, "t-j2a"), new_run_dir(spark, "t-j2b")
    sources = spark.createDataFrame(
        [("sa", "a", "file_extractor", _json.dumps({"url": files["a.bin"]})),
         ("sb", "b", "file_extractor", _json.dumps({"url": files["b.bin"]})),
         ("sx", "x", "file_extractor", "{}")],
        "id string, name string, type string, config string")
    loaders = spark.createDataFrame(
        [("l1", "one", "json_loader", _json.dumps({"path": out1})),
         ("l2", "two", "json_loader", _json.dumps({"path": out2}))],
        "id string, name string, type string, config string")
    conns = spark.createDataFrame(
        [("c1", ["sa"], ["l1"], "scheduled"), ("c2", ["sa"], ["l2"], "scheduled"),
         ("c3", ["sb"], ["l1"], "scheduled"), ("c4", ["sb"], ["l1"], "manual"),
         ("c5", ["sx"], ["l1"], "scheduled")],
        "id string, source_id array<string>, loader_id array<string>, sync_type string") \
        .withColumn("schedule", F.lit("0 * * * *"))
    got = {r["connection_id"]: (r["loaded"], r["reason"])
           for r in run_scheduled(spark, sources, loaders, conns, 4).collect()}
    # c4 is manual (not scheduled); c5 is scheduled but its config is invalid
    assert got == {"c1": (3, None), "c2": (3, None), "c3": (7, None), "c5": (None, "url is required")}
    rows = json_loader.read_back(spark, out1).where("connection_id = 'c3'").collect()
    assert sorted(r["seq"] for r in rows) == list(range(7))


def test_run_scheduled_pages(spark):
    import json as _json

    from ferry.plans.run import run_scheduled
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    first = pages.orderBy("page_id").first()
    out = new_run_dir(spark, "t-j2p")
    sources = spark.createDataFrame(
        [("p1", "page", "web_scraper", _json.dumps({"url": first["url"]})),
         ("p2", "none", "web_scraper", _json.dumps({"url": "https://nowhere.example/"}))],
        "id string, name string, type string, config string")
    loaders = spark.createDataFrame([("l1", "one", "json_loader", _json.dumps({"path": out}))],
                                    "id string, name string, type string, config string")
    conns = spark.createDataFrame([("w1", ["p1"], ["l1"], "scheduled", "0 * * * *"),
                                   ("w2", ["p2"], ["l1"], "scheduled", "0 * * * *")],
                                  "id string, source_id array<string>, loader_id array<string>, "
                                  "sync_type string, schedule string")
    n = -(-len(first["html"].encode()) // 1024)
    got = {r["connection_id"]: (r["loaded"], r["reason"])
           for r in run_scheduled(spark, sources, loaders, conns, 1024, pages=pages).collect()}
    assert got == {"w1": (n, None), "w2": (0, None)}
    skipped = {r["connection_id"]: r["reason"] for r in run_scheduled(spark, sources, loaders, conns, 1024).collect()}
    assert skipped == {"w1": "no pages table", "w2": "no pages table"}


def test_missing_source_file_fails_before_anything_is_written(spark, tmp_dir):
    import glob

    from ferry.session import local_path
    out = new_run_dir(spark, "t-missing")
    s, l_, c = single_connection_registry(spark, "cm", "file_extractor",
                                          {"url": os.path.join(tmp_dir, "absent.bin")},
                                          "json_loader", {"path": out})
    with pytest.raises(Exception, match="absent.bin"):
        run_connection(spark, "cm", s, l_, c)
    assert not glob.glob(local_path(out) + "/connection_id=*")


def test_run_scheduled_overlaps_absent_files_and_repeats(spark, tmp_dir):
    import json as _json

    from ferry.plans.run import run_scheduled
    d = os.path.join(tmp_dir, "dir")
    os.makedirs(d)
    for name, size in (("a.bin", 3), ("b.bin", 9), ("empty.bin", 0)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(bytes(range(size)))
    out1, out2 = new_run_dir(spark, "t-j2c"), new_run_dir(spark, "t-j2d")
    source_schema = "id string, name string, type string, config string"
    sources = spark.createDataFrame(
        [(i, i, "file_extractor", _json.dumps({"url": u})) for i, u in
         (("file", d + "/a.bin"), ("dir", d), ("absent", d + "/none.bin"), ("empty", d + "/empty.bin"))],
        source_schema)
    loaders = spark.createDataFrame([(f"l{i}", f"l{i}", "json_loader", _json.dumps({"path": o}))
                                     for i, o in ((1, out1), (2, out2))], source_schema)
    conns = spark.createDataFrame(
        [("c-file", ["file"], ["l1"]), ("c-dir", ["dir"], ["l1"]), ("c-dir2", ["dir"], ["l2"]),
         ("c-absent", ["absent"], ["l1"]), ("c-empty", ["empty"], ["l1"]), ("c-lost", ["nope"], ["l1"]),
         ("c-lost2", ["file"], ["nope"])],
        "id string, source_id array<string>, loader_id array<string>") \
        .withColumn("sync_type", F.lit("scheduled")).withColumn("schedule", F.lit("0 * * * *"))
    want = {"c-file": (1, None), "c-dir": (4, None), "c-dir2": (4, None), "c-empty": (0, None),
            "c-absent": (None, "source not found"), "c-lost": (None, "Invalid source_id"),
            "c-lost2": (None, "Invalid loader_id")}
    for _ in range(2):
        got = {r["connection_id"]: (r["loaded"], r["reason"])
               for r in run_scheduled(spark, sources, loaders, conns, 3).collect()}
        assert got == want
        back = json_loader.read_back(spark, out1).collect()
        assert sorted((r["connection_id"], r["seq"]) for r in back) == [("c-dir", i) for i in range(4)] + [("c-file", 0)]
        assert json_loader.read_back(spark, out2).count() == 4
    with open(os.path.join(d, "a.bin"), "wb"):
        pass  # now empty: the next run leaves no row of it
    got = {r["connection_id"]: r["loaded"] for r in run_scheduled(spark, sources, loaders, conns, 3).collect()}
    assert (got["c-file"], got["c-dir"]) == (0, 3)
    assert {r["connection_id"] for r in json_loader.read_back(spark, out1).collect()} == {"c-dir"}


def test_run_connection_directory_and_repeat(spark, tmp_dir):
    for name, size in (("a.bin", 5), ("b.bin", 2)):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(bytes(size))
    out = new_run_dir(spark, "t-dir")
    s, l_, c = single_connection_registry(spark, "cd", "file_extractor", {"url": tmp_dir}, "json_loader", {"path": out})
    for _ in range(2):
        assert run_connection(spark, "cd", s, l_, c, chunk_bytes=2).first()["loaded"] == 4
        back = sorted(json_loader.read_back(spark, out).collect(), key=lambda r: r["seq"])
        assert [(r["seq"], os.path.basename(r["metadata"]["source"])) for r in back] == [
            (0, "a.bin"), (1, "a.bin"), (2, "a.bin"), (3, "b.bin")]


def test_registered_type_runs(spark):
    from ferry.functions import config as cfg
    from ferry.operators import registry as reg
    from ferry.sources import connectors
    known = dict(cfg.CONFIG_FIELDS), dict(reg.CONNECTORS)
    connectors.register_source("rows", lambda sp, config, **_: sp.range(int(config["n"])).select(
        F.col("id").alias("seq"), F.encode(F.col("id").cast("string"), "UTF-8").alias("data")), field="n")
    try:
        out = new_run_dir(spark, "t-rows")
        s, l_, c = single_connection_registry(spark, "cr", "rows", {"n": "3"}, "json_loader", {"path": out})
        assert run_connection(spark, "cr", s, l_, c).first()["loaded"] == 3
        assert reg.lookup_connector(s).first()["connector"] == "rows"
        s, l_, c = single_connection_registry(spark, "cr", "rows", {}, "json_loader", {"path": out})
        with pytest.raises(ValueError, match="n is required"):
            run_connection(spark, "cr", s, l_, c)
    finally:
        cfg.CONFIG_FIELDS.clear(), cfg.CONFIG_FIELDS.update(known[0])
        reg.CONNECTORS.clear(), reg.CONNECTORS.update(known[1])


def test_override_with_an_empty_snapshot(spark):
    from ferry.sinks import snapshot
    out = new_run_dir(spark, "t-empty-snapshot")
    df = spark.createDataFrame([("a/b", 1), ("c", 2)], "connection_id string, v int")
    snapshot.override_partitions(df, out, ["connection_id"])
    snapshot.override_partitions(df.where("v = 2"), out, ["connection_id"], replaced=["a/b", "c", "new"])
    assert [tuple(r) for r in spark.read.parquet(out).select("connection_id", "v").collect()] == [("c", 2)]
