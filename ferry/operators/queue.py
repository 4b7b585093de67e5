"""Queue semantics on DataFrames: parse with quarantine (C3, B6) and the
order-dependent "until end" cut (G1)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.plans.sizing import broadcast_if_small


def parse_messages(lines: DataFrame, value_col: str = "value",
                   keep: list[str] | tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """JSON lines -> message rows plus ``_reject`` (null when good).

    Malformed lines are kept, not skipped: ``_reject`` holds the reason and
    the raw line stays in ``_raw``. Split with ``good`` / ``rejects``.

    Spark's JSON reader accepts trailing text after the first object
    (``{"IsEnd": true} x``). Lines written by ``publish`` never look like
    that; for foreign producers ``strict=True`` adds a whole-line check
    (``json_object_line``) and rejects such lines too.
    """
    parsed = lines.select(*keep, F.col(value_col).alias("_raw"), env.parse(value_col).alias("_m"))
    bad = env.is_malformed("_m")
    if strict:
        bad = bad | ~json_object_line(F.col("_raw"))
    reason = (F.when(F.col("_raw").isNull(), F.lit("null message"))
              .when(bad, F.lit("malformed message")))
    fields = [F.col("_m").getField(f.name).alias(f.name) for f in env.MESSAGE_SCHEMA.fields]
    return parsed.select(*keep, "_raw", *fields, reason.alias("_reject"))


def json_object_line(col) -> Column:
    """True when the whole line is exactly one JSON object: put in brackets it
    is an array of one element, and it starts with a brace."""
    one = F.from_json(F.concat(F.lit("["), col, F.lit("]")), "array<string>")
    return F.coalesce((F.size(one) == 1) & F.ltrim(col).startswith("{"), F.lit(False))


def good(parsed: DataFrame) -> DataFrame:
    """Loaded side of ``parse_messages``; a missing ``IsEnd`` reads as false."""
    return (parsed.where(F.col("_reject").isNull())
            .withColumn("IsEnd", F.coalesce(F.col("IsEnd"), F.lit(False)))
            .drop("_reject", "_raw"))


def rejects(parsed: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Quarantined side: the raw line and the reason."""
    return parsed.where(F.col("_reject").isNotNull()).select(
        *keep, F.col("_raw").alias("raw"), F.col("_reject").alias("reason"))


def until_end(messages: DataFrame, queue_col: str = "queue", seq_col: str = "seq",
              end_col: str = "IsEnd", observation=None) -> DataFrame:
    """G1: per queue, the rows before its first end marker (marker dropped).

    The first marker of each queue is found with an aggregate (partial
    aggregation first, so a hot queue costs one row per map task), written to
    the scratch folder, and joined back. The markers table has one row per
    queue: it is broadcast only when its count is proven small; otherwise a
    shuffled left join runs and AQE splits a skewed queue. No window over a
    queue, so no queue ever has to fit in one task. Null queues form one
    queue. Where the messages carry ``connection_id``, a queue is one of its
    connection: equal names of two connections end apart.

    ``observation`` (a ``pyspark.sql.Observation``) receives ``read`` (all
    messages, markers included) and ``loaded`` (rows kept) from the job
    that consumes the result.
    """
    is_end = F.coalesce(F.col(end_col), F.lit(False))
    if _provably_empty(messages.where(is_end)):
        # no row can be a marker (e.g. IsEnd is the constant false of a file
        # source): Catalyst folded the marker filter away, nothing to join
        if observation is not None:
            messages = messages.observe(observation, F.count(F.lit(1)).alias("read"),
                                        F.count(F.lit(1)).cast("long").alias("loaded"))
        return messages
    keys = [queue_col] + [c for c in ("connection_id",) if c in messages.columns and c != queue_col]
    ends = (messages.where(is_end)
            .groupBy(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)]).agg(F.min(seq_col).alias("_end_seq")))
    ends = broadcast_if_small(ends, materialize_first=True, name="queue-ends")
    same = reduce(and_, [messages[k].eqNullSafe(ends[f"_q{i}"]) for i, k in enumerate(keys)])
    joined = messages.join(ends, same, "left").drop(*[f"_q{i}" for i in range(len(keys))])
    keep = (~is_end) & (F.col("_end_seq").isNull() | (F.col(seq_col) < F.col("_end_seq")))
    if observation is not None:
        joined = joined.observe(observation, F.count(F.lit(1)).alias("read"),
                                F.coalesce(F.sum(F.when(keep, 1).otherwise(0)), F.lit(0)).cast("long").alias("loaded"))
    return joined.where(keep).drop("_end_seq")


def _provably_empty(df: DataFrame) -> bool:
    """True when the optimised plan is an empty local relation (no job)."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        return plan.getClass().getSimpleName() == "LocalRelation" and plan.data().isEmpty()
    except Exception:  # no JVM handle: assume rows may exist
        return False
