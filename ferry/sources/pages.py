"""Page source (A4): pages already fetched, as payload rows.

The reference's scraper has an empty body; fetching over HTTP per row is a
network client, not data work. Here the source is a table of fetched pages
``(page_id, url, html)``; a url or url-prefix selects pages (the filter is
pushed to the parquet scan) and the html becomes the byte payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.plans.sizing import broadcast_if_small


def read_pages(spark: SparkSession, pages: DataFrame | str, url: str | None = None,
               url_prefix: str | None = None) -> DataFrame:
    df = spark.read.parquet(pages) if isinstance(pages, str) else pages
    if url is not None:
        df = df.where(F.col("url") == F.lit(url))
    if url_prefix is not None:
        df = df.where(F.col("url").startswith(url_prefix))
    return df.select("page_id", "url", F.encode(F.col("html"), "UTF-8").alias("data"))


def join_prefixes(pages: DataFrame, registered: DataFrame, prefix_col: str = "_url") -> DataFrame:
    """Every page with every registered row whose prefix its url starts with.

    A page's url is cut at each length that a registered prefix has (a url has
    few of them; there are no more distinct lengths than characters in the
    longest prefix), and the cuts meet the prefixes by equality: each pair
    once, no comparison of every page with every prefix."""
    sides = broadcast_if_small(registered, name="prefixes")
    lengths = sorted(r[0] for r in sides.select(F.length(prefix_col)).distinct().collect() if r[0])
    possible = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("url"))
    cuts = pages.select("*", F.explode(F.transform(possible, lambda n: F.substring(F.col("url"), F.lit(1), n))).alias("_cut"))
    return cuts.join(sides, cuts["_cut"] == sides[prefix_col]).drop("_cut")
