"""Loading the driver tables and deriving registry tables from them.

The registry (sources, loaders, connections) is derived from the star
schema so that its size grows with the data: one source per customer, one
loader per supplier, one connection per order. The derivation rules are
mirrored exactly by the DuckDB oracle SQL in ``ferry.plans.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.plans.sizing import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table. With ``spread_rows`` (for heavy per-row work such as
    JSON encoding) it is dealt over the partitions that the session asks for
    (see ``sizing.spread``)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per customer. Segment BUILDING reads fetched pages
    (``web_scraper``), MACHINERY declares an API source that no connector
    implements, the rest read files. A non-positive balance leaves the url
    empty, which the config check rejects."""
    c = table(spark, sf_dir, "customer")
    typ = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("web_scraper"))
           .when(F.col("c_mktsegment") == "MACHINERY", F.lit("api"))
           .otherwise(F.lit("file_extractor")))
    url = F.when(F.col("c_acctbal") > 0,
                 F.concat(F.lit("/data/customer/"), F.col("c_custkey").cast("string"), F.lit(".txt"))
                 ).otherwise(F.lit(""))
    return c.select(F.col("c_custkey").cast("string").alias("id"),
                    F.col("c_name").alias("name"), typ.alias("type"),
                    F.to_json(F.struct(url.alias("url"))).alias("config"))


def loaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON loader per supplier; a non-positive balance gives ``{}``."""
    s = table(spark, sf_dir, "supplier")
    cfg = F.when(F.col("s_acctbal") > 0,
                 F.to_json(F.struct(F.concat(F.lit("/out/"), F.col("s_suppkey").cast("string"),
                                             F.lit("/")).alias("path")))).otherwise(F.lit("{}"))
    return s.select(F.col("s_suppkey").cast("string").alias("id"),
                    F.col("s_name").alias("name"), F.lit("json_loader").alias("type"),
                    cfg.alias("config"))


def connections(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """One connection per order: source = its customer, loader = supplier
    ``o_orderkey % 100``; status F is manual, O scheduled (hourly), P gets
    an unsupported sync type."""
    o = table(spark, sf_dir, "orders", spread_rows)
    sync = (F.when(F.col("o_orderstatus") == "F", F.lit("manual"))
            .when(F.col("o_orderstatus") == "O", F.lit("scheduled"))
            .otherwise(F.lit("hourly")))
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.array(F.col("o_custkey").cast("string")).alias("source_id"),
        F.array((F.col("o_orderkey") % 100).cast("string")).alias("loader_id"),
        sync.alias("sync_type"),
        F.when(F.col("o_orderstatus") == "O", F.lit("0 * * * *")).alias("schedule"),
        F.lit(None).cast("string").alias("config"),
    )
