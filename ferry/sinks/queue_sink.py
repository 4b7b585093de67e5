"""Queue sink (B1, B4): message rows -> JSON lines in a landing directory.

Each line holds one message, with ``connection_id``, ``queue`` and ``seq``
inside the JSON, so a line is self-describing. Lines are grouped into
``queue_bucket=<b>`` directories by a hash of the queue: the number of
directories (and of files per writing task) stays bounded however many
queues there are, and a consumer of one queue reads one bucket only. A
landing directory is written once per run, so a re-run never sees leftovers
of an older one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.sinks.snapshot import _hadoop_fs as hadoop_fs

QUEUE_DIR_COL = "queue_bucket"
DEFAULT_BUCKETS = 16
# Hidden from readers by the leading underscore.
BUCKETS_MARK = "_buckets-"


def queue_bucket(queue, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Bucket of a queue name: ``pmod(xxhash64(queue), buckets)``."""
    q = F.col(queue) if isinstance(queue, str) else queue
    return F.pmod(F.xxhash64(q), F.lit(buckets)).cast("int")


def publish(messages: DataFrame, landing_dir: str, mode: str = "append",
            buckets: int = DEFAULT_BUCKETS) -> str:
    """Write message rows (``MESSAGE_SCHEMA`` columns) as JSON lines.

    The writer sorts each task's rows by bucket before writing, so a task
    keeps one file open at a time and writes at most ``buckets`` files.
    """
    lines = messages.select(queue_bucket(F.col("queue"), buckets).alias(QUEUE_DIR_COL),
                            env.serialize().alias("value"))
    lines.write.mode(mode).partitionBy(QUEUE_DIR_COL).text(landing_dir)
    fs, root, jvm = hadoop_fs(messages.sparkSession, landing_dir)
    fs.create(jvm.org.apache.hadoop.fs.Path(root, f"{BUCKETS_MARK}{buckets}"), True).close()
    return landing_dir


def stored_buckets(spark, landing_dir: str) -> set[int]:
    """The bucket counts that runs wrote this landing directory with."""
    fs, root, _ = hadoop_fs(spark, landing_dir)
    if not fs.exists(root):
        return set()
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return {int(n[len(BUCKETS_MARK):]) for n in names if n.startswith(BUCKETS_MARK)}


def publish_end_markers(spark, queues: DataFrame, landing_dir: str,
                        buckets: int = DEFAULT_BUCKETS) -> str:
    """One end marker per (connection_id, queue, seq) row of ``queues``."""
    markers = queues.select(*env.end_marker(F.col("connection_id"), F.col("queue"), F.col("seq")))
    return publish(markers, landing_dir, buckets=buckets)


def publish_kafka(messages: DataFrame, bootstrap_servers: str, topic: str,
                  options: dict | None = None) -> None:
    """B4 on a broker: the same JSON lines as Kafka records keyed by queue.
    Needs the ``spark-sql-kafka`` package on the classpath (not bundled)."""
    records = messages.select(F.col("queue").cast("string").alias("key"), env.serialize().alias("value"))
    writer = (records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save()
