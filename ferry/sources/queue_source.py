"""Queue source (A3): JSON lines of a landing directory -> message rows.

Batch reads use ``spark.read.text``; the streaming twin is in
``ferry.streaming.sync``. Partition values are kept as strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators import queue as q
from ferry.sinks.queue_sink import QUEUE_DIR_COL, queue_bucket, stored_buckets

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                            T.StructField(QUEUE_DIR_COL, T.IntegerType())])


def read_lines(spark: SparkSession, landing_dir: str) -> DataFrame:
    return spark.read.schema(LINE_SCHEMA).text(landing_dir)


def consume(spark: SparkSession, landing_dir: str, queue: str | None = None,
            buckets: int | None = None) -> DataFrame:
    """Parsed messages with the ``_reject`` column (see ``operators.queue``).
    With ``queue`` only that queue's bucket directory is read (partition
    pruning), then the queue itself is selected. The bucket count is the one
    stored in the landing directory; runs with several counts, or a directory
    without one, are read whole."""
    lines = read_lines(spark, landing_dir)
    if queue is None:
        return q.parse_messages(lines)
    counts = {buckets} if buckets else stored_buckets(spark, landing_dir)
    one = lines
    if len(counts) == 1:
        one = lines.where(F.col(QUEUE_DIR_COL) == queue_bucket(F.lit(queue), counts.pop()))
    parsed = q.parse_messages(one)
    return parsed.where((F.col("queue") == F.lit(queue)) | F.col("_reject").isNotNull())


def consume_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, streaming: bool = True,
                  options: dict | None = None) -> DataFrame:
    """A3 on a broker: Kafka records -> parsed messages (``_reject`` kept).
    Needs the ``spark-sql-kafka`` package on the classpath (not bundled)."""
    reader = spark.readStream if streaming else spark.read
    reader = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    lines = reader.load().selectExpr("CAST(value AS STRING) AS value")
    return q.parse_messages(lines)
