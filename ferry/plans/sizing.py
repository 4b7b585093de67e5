"""Size checks in front of every broadcast, and lineage cuts.

A side is broadcast only after its rows and bytes are measured below both
bounds. The side is written once to the shared scratch folder and measured
by the job that writes it, so it is evaluated once and nothing gathers in
one task. Beyond the bounds the join is left to the planner (sort-merge with
AQE skew splitting, or AQE's own runtime broadcast when the real shuffle
output is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ferry.session import new_run_dir

# Upper bound of rows for an explicit broadcast of a narrow side
# (key + a few short columns). Overridable per session.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
MAX_ROWS_CONF = "spark.ferry.broadcast.maxRows"
# Upper bound of the side's bytes (its rows as JSON text).
DEFAULT_BROADCAST_MAX_BYTES = 128 << 20
MAX_BYTES_CONF = "spark.ferry.broadcast.maxBytes"

# Sides estimated above this are never measured for a broadcast.
DEFAULT_BROADCAST_MAX_ESTIMATE = 1 << 30
MAX_ESTIMATE_CONF = "spark.ferry.broadcast.maxEstimateBytes"
# Partitions that row-heavy scans are dealt over; unset: the input splits decide.
SPREAD_CONF = "spark.ferry.spread.partitions"


def broadcast_max_rows(spark) -> int:
    return int(spark.conf.get(MAX_ROWS_CONF, str(DEFAULT_BROADCAST_MAX_ROWS)))


def broadcast_max_estimate(spark) -> int:
    return int(spark.conf.get(MAX_ESTIMATE_CONF, str(DEFAULT_BROADCAST_MAX_ESTIMATE)))


def materialize(df: DataFrame, name: str = "side") -> DataFrame:
    """Write ``df`` to a fresh parquet table in the shared scratch folder and
    read it back: lineage is cut, later scans are cheap, and the data is on
    storage that outlives any executor."""
    spark = df.sparkSession
    path = new_run_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def materialize_measured(df: DataFrame, name: str = "side") -> tuple[DataFrame, int, int]:
    """``materialize``, with the row count and the bytes of the rows as JSON
    text, both taken by the job that writes."""
    seen = Observation(f"measure-{name}")
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows"),
                                     F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes")), name)
    got = seen.get
    if "rows" not in got:  # Catalyst proved the side empty and dropped the measure
        return written, 0, 0
    return written, got["rows"], got["bytes"]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (no job). For file scans it is the
    file size scaled by the columns read; it is used only to skip the exact
    measure for sides that are clearly large."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # no JVM handle (Spark Connect): size unknown
        return int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))


def broadcast_if_small(df: DataFrame, max_rows: int | None = None,
                       materialize_first: bool = False, name: str = "side") -> DataFrame:
    """Return ``df``, written, as a broadcast side when it is measured to have
    at most ``max_rows`` rows and the byte bound's bytes, else without a hint
    (the planner then shuffles both sides).

    A side whose size estimate already exceeds the estimate limit is left to
    the planner unmeasured (and written only with ``materialize_first``)."""
    spark = df.sparkSession
    bound = max_rows if max_rows is not None else broadcast_max_rows(spark)
    est = estimated_bytes(df)
    unknown = est >= int(spark.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))
    if not unknown and est > broadcast_max_estimate(spark):
        return materialize(df, name) if materialize_first else df
    df, rows, size = materialize_measured(df, name)
    max_bytes = int(spark.conf.get(MAX_BYTES_CONF, str(DEFAULT_BROADCAST_MAX_BYTES)))
    return F.broadcast(df) if rows <= bound and size <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt round-robin over the partitions the session asks for
    (``spark.ferry.spread.partitions``), whatever the size of ``df``; where
    that is unset, as at cluster scale, the scan keeps its input splits and
    there is no shuffle."""
    asked = df.sparkSession.conf.get(SPREAD_CONF, "")
    return df.repartition(int(asked)) if asked else df
