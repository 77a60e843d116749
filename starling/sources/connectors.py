"""Thin connector functions (JDBC tables, Kafka topics).

Neither a JDBC driver nor the Kafka source is on this image's classpath; the
functions only configure Spark's built-in readers, and tests use files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Full or partitioned JDBC scan; column pruning / filters are pushed to the database."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000) -> None:
    """Append with batched multi-row inserts from the executors (``batchsize``)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()


def kafka_stream(spark: SparkSession, brokers: str, topic: str, options: dict[str, str] | None = None) -> DataFrame:
    """Kafka topic as a stream of (key, value, topic, partition, offset, timestamp).

    ``options`` come from a consumer policy (``streaming.consumer``).  The checkpoint of the
    query that reads it replaces the consumer group's offsets.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
            .options(**(options or {})).load())
