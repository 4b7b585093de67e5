from pyspark.sql import functions as F

from ferry.functions import config as cfg
from ferry.operators import registry as reg


def _parse(spark, rows):
    df = spark.createDataFrame(rows, "type string, config string")
    return [r["p"] for r in df.select(cfg.parse_config("type", "config").alias("p")).collect()]


def test_config_parse_cases(spark):
    got = _parse(spark, [
        ("file_extractor", '{"url": "/a.txt"}'),
        ("file_extractor", "{}"),
        ("file_extractor", '{"url": ""}'),
        ("web_scraper", "{}"),
        ("json_loader", '{"path": "/out/"}'),
        ("json_loader", '{"url": "/a.txt"}'),   # another type's config
        ("json_loader", "not json"),
        ("kafka", '{"url": "x"}'),
        (None, "{}"),
    ])
    assert got[0]["url"] == "/a.txt" and got[0]["error"] is None
    assert got[1]["error"] == "url is required"
    assert got[2]["error"] == "url is required"
    assert got[3]["error"] == "URL is required"
    assert got[4]["path"] == "/out/" and got[4]["error"] is None and got[4]["url"] is None
    assert got[5]["error"] == "path is required"
    assert got[6]["error"] == cfg.BAD_JSON_MESSAGE
    assert got[7]["error"] == "unknown config type: kafka"
    assert got[8]["error"] == "unknown config type: "


def _registry(spark):
    sources = spark.createDataFrame([("s1", "n", "file_extractor", '{"url":"/x"}')],
                                    "id string, name string, type string, config string")
    loaders = spark.createDataFrame([("l1", "n", "json_loader", '{"path":"/o/"}')],
                                    "id string, name string, type string, config string")
    return sources, loaders


def test_reference_check_order(spark):
    sources, loaders = _registry(spark)
    conns = spark.createDataFrame([
        ("c1", ["s1"], ["l1"]), ("c2", ["bad"], ["bad"]), ("c3", ["s1"], ["bad"]),
        ("c4", [], ["l1"]), ("c5", ["s1", "s9"], ["l1"])],
        "id string, source_id array<string>, loader_id array<string>")
    got = {r["connection_id"]: r["reason"] for r in reg.check_references(conns, sources, loaders).collect()}
    assert got == {"c1": None, "c2": "Invalid source_id", "c3": "Invalid loader_id",
                   "c4": "Invalid source_id", "c5": None}


def test_required_fields(spark):
    df = spark.createDataFrame([("c1", [], ["l"], "manual"), ("c2", ["s"], ["l"], " "),
                                ("c3", ["s"], ["l"], "manual")],
                               "id string, source_id array<string>, loader_id array<string>, sync_type string")
    got = {r["id"]: r["reason"] for r in reg.required_check(df, "connections").collect()}
    assert got == {"c1": "source_id is required", "c2": "sync_type is required", "c3": None}


def test_routes(spark):
    df = spark.createDataFrame([("manual",), ("scheduled",), ("hourly",), (None,)], "sync_type string")
    assert [r["route"] for r in reg.route_sync_type(df).collect()] == \
        ["manual", "scheduled", "invalid", "invalid"]


def test_resolve_and_options(spark):
    sources, loaders = _registry(spark)
    conns = spark.createDataFrame([("c1", ["s1"], ["l1"], "manual")],
                                  "id string, source_id array<string>, loader_id array<string>, sync_type string")
    r = reg.resolve_connections(conns, sources, loaders)
    row = r.first()
    assert row["queue"] == "file_extractor_c1" and row["source_cfg"]["url"] == "/x"
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    env = r.select(cfg.options_list(cfg.merge_options(
        F.create_map(F.lit("URL"), F.lit("old"), F.lit("q"), F.lit("1")),
        cfg.config_to_options("source_type", "source_cfg"))).alias("e")).first()["e"]
    assert env == ["Q=1", "URL=/x"]  # later map wins, keys upper-cased, sorted
    # keys differing in case are distinct until the list is built (as in Go)
    env2 = r.select(cfg.options_list(cfg.merge_options(
        F.create_map(F.lit("url"), F.lit("old")),
        cfg.config_to_options("source_type", "source_cfg"))).alias("e")).first()["e"]
    assert env2 == ["URL=/x", "URL=old"]


def test_options_to_config(spark):
    df = spark.createDataFrame([("file_extractor", {"URL": "/a"}), ("json_loader", {}),
                                ("x", {})], "type string, m map<string,string>")
    got = [r["c"] for r in df.select(cfg.options_to_config("type", "m").alias("c")).collect()]
    assert got[0]["url"] == "/a" and got[0]["error"] is None
    assert got[1]["error"] == "PATH environment variable not set"
    assert got[2]["error"] == "unknown config type: x"


def test_connector_lookup(spark):
    df = spark.createDataFrame([("json_loader",), ("api",)], "type string")
    got = {r["type"]: (r["connector"], r["reason"]) for r in reg.lookup_connector(df).collect()}
    assert got == {"json_loader": ("json", None), "api": (None, "unknown type")}


def test_first_id_and_names(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "ids array<string>")
    assert [r["f"] for r in df.select(cfg.first_id("ids").alias("f")).collect()] == ["a", None]
    r = spark.range(1).select(cfg.queue_name(F.lit("file_extractor"), F.lit("c")).alias("q"),
                              cfg.output_file(F.lit("/o/"), F.lit("c")).alias("f")).first()
    assert (r["q"], r["f"]) == ("file_extractor_c", "/o/c.json")


def test_append_registry_keeps_rejects(spark, tmp_dir):
    df = spark.createDataFrame([("s1", "n", "file_extractor", '{"url":"/x"}'),
                                ("s2", "n", "file_extractor", "{}"),
                                ("s3", "", "file_extractor", '{"url":"/y"}')],
                               "id string, name string, type string, config string")
    rej = {r["id"]: r["reason"] for r in reg.append_registry(df, "sources", tmp_dir + "/reg").collect()}
    assert rej == {"s2": "url is required", "s3": "name is required"}
    assert [r["id"] for r in spark.read.parquet(tmp_dir + "/reg").collect()] == ["s1"]
