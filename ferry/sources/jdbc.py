"""Database source and sink (A5, B3) over Spark's JDBC data source.

Reads are split into ``num_partitions`` range scans on a numeric or date
column, so one table is read by many tasks; an incremental sync passes its
cursor as a ``where`` predicate that the database evaluates. Writes use the
JDBC batch writer with a bounded number of connections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int = 1,
               predicate: str | None = None, properties: dict | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    src = f"(SELECT * FROM {table} WHERE {predicate}) t" if predicate else table
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", src)
              .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None and num_partitions > 1:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                properties: dict | None = None, max_connections: int = 16,
                batch_size: int = 10_000) -> None:
    # at most max_connections open at once; the upstream work keeps its own partitions
    writer = (df.repartition(max_connections).write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)).mode(mode))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
