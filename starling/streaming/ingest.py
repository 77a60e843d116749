"""The event-log stream: topic -> decode -> append-only log.

Source: any streaming frame with a ``value`` column (Kafka via
``sources.connectors.kafka_stream``, or a file source in tests).  The
checkpoint replaces the consumer group's offsets; the Parquet file sink is
exactly-once per micro-batch, so a restart resumes without duplicates (the
original consumers were at-least-once and one could lose its 10-row buffer).
Quarantined (malformed) messages go to their own sink.  ``ingested_at`` is
``current_timestamp()``, fixed per micro-batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starling.streaming.decode import decode, quarantine

FEED_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                            T.StructField("seq", T.LongType()), T.StructField("ts", T.TimestampType())])


def file_feed(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA,
              max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A directory of feed files as a stream (stand-in for the broker in tests)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start_event_log(source: DataFrame, sink_path: str, checkpoint: str, policy: str = "strict",
                    available_now: bool = True, processing_time: str | None = None,
                    quarantine_path: str | None = None) -> list[StreamingQuery]:
    """Start the log query (and the quarantine query); partitioned by ingest date."""
    log = decode(source, policy).withColumn("ingest_date", F.to_date("ingested_at"))
    queries = [_start(log, sink_path, f"{checkpoint}/log", available_now, processing_time, "ingest_date",
                      f"event_log_{policy}")]
    if quarantine_path:
        bad = quarantine(source)
        queries.append(_start(bad, quarantine_path, f"{checkpoint}/quarantine", available_now, processing_time,
                              None, "event_quarantine"))
    return queries


def _start(df: DataFrame, path: str, ckpt: str, available_now: bool, processing_time: str | None,
           partition_by: str | None, name: str | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).outputMode("append")
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def start_event_log_foreach_batch(source: DataFrame, table_path: str, checkpoint: str,
                                  policy: str = "strict") -> StreamingQuery:
    """Stream -> table via foreachBatch, idempotent per micro-batch.

    Each micro-batch is written into its own partition of the stream's id and the batch's
    with dynamic partition overwrite: a batch replayed after a failure replaces exactly its
    own earlier output -- no scan of the growing table.  The stream's id lives in its
    checkpoint, so another feed or a new checkpoint never meets this one's partitions.
    """
    decoded = decode(source, policy)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("stream_id", F.lit(stream_id(batch.sparkSession, checkpoint)))
              .withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("stream_id", "batch_id").parquet(table_path))

    return (decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
