"""The topic consumer: one read and one parse of every micro-batch, several sinks, exact counts.

A ``ConsumerPolicy`` holds what tells the two consumers apart: how messages are decoded, where a
new consumer starts in the topic, and how much one micro-batch may hold.  It yields the reader's
options, for a Kafka topic as well as for a folder of feed files.

``start`` runs one streaming query with one checkpoint.  In each micro-batch the parsed messages
are written to the event log, the broken ones (key and raw value) to the quarantine, and
a row of counts to the counts table.  All three write into a partition named by the
stream's id and the batch's, overwritten as a whole, so a batch that is repeated after a failure
replaces what it wrote before.  ``ingested_at`` is the batch's time, which Spark keeps in the
checkpoint: a repeated batch carries the same one.

Counts are observed while the rows are written, without another pass, and kept per batch, so
that ``totals`` is exact after any number of batches and restarts.

Where a consumer starts (``starting_offsets``) matters at its first start alone; afterwards
its checkpoint decides.  ``latest`` on a folder leaves out the files that lay there at
the first start; that moment is kept in a folder beside the checkpoint.  A lost offset fails the query.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starling.sources.connectors import kafka_stream
from starling.sources.files import path_exists
from starling.streaming.decode import decode_parsed, first_amount, parse, running_amount_label
from starling.streaming.ingest import FEED_SCHEMA, stream_id


@dataclass(frozen=True)
class ConsumerPolicy:
    """How a consumer decodes, where it starts, and what one micro-batch holds at most."""
    decode: str                       # "strict" or "lenient"
    starting_offsets: str             # "earliest" or "latest"
    rows: int | None = None           # messages per micro-batch (Kafka)
    files: int | None = None          # feed files per micro-batch (folder)
    max_bytes: str | None = None      # bytes of feed files per micro-batch (folder), e.g. "1g"

    def with_limits(self, **limits) -> "ConsumerPolicy":
        return dataclasses.replace(self, **limits)

    def kafka_options(self) -> dict[str, str]:
        found = {"startingOffsets": self.starting_offsets, "failOnDataLoss": "true"}
        if self.rows:
            found["maxOffsetsPerTrigger"] = str(self.rows)
        return found

    def folder_options(self) -> dict[str, str]:
        # Spark takes one of the two
        if self.files and self.max_bytes:
            raise ValueError("files or max_bytes, not both")
        if self.files:
            return {"maxFilesPerTrigger": str(self.files)}
        return {"maxBytesPerTrigger": self.max_bytes} if self.max_bytes else {}


STRICT = ConsumerPolicy("strict", "earliest")
LENIENT = ConsumerPolicy("lenient", "latest")
POLICIES = {"strict": STRICT, "lenient": LENIENT}
MIRROR_ROWS = 10      # messages that the original mirror consumer inserts at a time


@dataclass(frozen=True)
class Sinks:
    log: str
    counts: str
    quarantine: str | None = None     # None: broken messages are counted only


COUNTS = T.StructType([T.StructField("received", T.LongType()), T.StructField("broken", T.LongType()),
                       T.StructField("logged", T.LongType()), T.StructField("amount", T.DecimalType(38, 2)),
                       T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def kafka_topic(spark: SparkSession, policy: ConsumerPolicy, brokers: str, topic: str) -> DataFrame:
    return kafka_stream(spark, brokers, topic, policy.kafka_options())


def folder_topic(spark: SparkSession, policy: ConsumerPolicy, folder: str, checkpoint: str,
                 schema: T.StructType = FEED_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """A folder of feed files as a topic; a glob such as ``in/*`` is fine."""
    reader = spark.readStream.schema(schema).format(fmt).options(**policy.folder_options())
    rows = reader.load(folder)
    since = first_start(spark, policy, folder, checkpoint)
    if since is None:
        return rows
    return rows.where(F.col("_metadata.file_modification_time") > F.lit(since)).select(*schema.names)


def first_start(spark: SparkSession, policy: ConsumerPolicy, folder: str, checkpoint: str):
    """Time of the newest feed file at this consumer's first start; None where it reads from the earliest on."""
    if policy.starting_offsets == "earliest":
        return None
    kept = f"{checkpoint.rstrip('/')}-start"
    if not path_exists(spark, kept):
        # file times from the listing alone; contents are not read
        files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(folder)
        files.agg(F.max("modificationTime").alias("newest")).coalesce(1).write.json(kept, timestampFormat=_MOMENT)
    return spark.read.schema("newest timestamp").json(kept, timestampFormat=_MOMENT).first()["newest"]


_MOMENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def messages(topic: DataFrame) -> DataFrame:
    """A topic's messages, parsed, with the batch's time: the key as text, whatever the source's type."""
    keyed = topic.withColumn("key", F.col("key").cast("string")) if "key" in topic.columns else \
        topic.withColumn("key", F.lit(None).cast("string"))
    return parse(keyed).withColumn("ingested_at", F.current_timestamp())


def start(topic: DataFrame, sinks: Sinks, checkpoint: str, policy: ConsumerPolicy = STRICT, available_now: bool = True,
          processing_time: str = "10 seconds", name: str | None = None) -> StreamingQuery:
    """Consume a topic into its sinks: all there is (``available_now``), or for ever."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, stream_id(batch.sparkSession, checkpoint), sinks, policy)

    writer = messages(topic).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return writer.trigger(**trigger).start()


def write_batch(batch: DataFrame, batch_id: int, stream: str, sinks: Sinks, policy: ConsumerPolicy) -> dict[str, int]:
    """One parsed micro-batch into all sinks; returns its counts."""
    spark = batch.sparkSession
    if sinks.quarantine:
        # two sinks read it: parsed once, and recomputed from the topic's fixed offsets if executors are lost
        batch = batch.persist()
    try:
        seen, logged = Observation(), Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if("malformed").alias("broken"))
        log = decode_parsed(rows, policy.decode, F.col("ingested_at")).observe(
            logged, F.count(F.lit(1)).alias("logged"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
        overwrite(log.withColumn("ingest_date", F.to_date("ingested_at")), sinks.log, stream, batch_id, "ingest_date")
        counts = {**seen.get, **logged.get}
        if sinks.quarantine and counts["broken"]:
            bad = batch.where("malformed").select(
                "key", F.col("value").cast("string").alias("raw_value"), "ingested_at",
                *[c for c in ("topic", "partition", "offset", "seq") if c in batch.columns])
            overwrite(bad, sinks.quarantine, stream, batch_id)
        # last: a batch with counts is complete
        row = spark.createDataFrame([(counts["received"], counts["broken"], counts["logged"], counts["amount"])],
                                    T.StructType(COUNTS.fields[:4]))
        overwrite(row.coalesce(1), sinks.counts, stream, batch_id)
        return counts
    finally:
        if sinks.quarantine:
            batch.unpersist()


def overwrite(df: DataFrame, path: str, stream: str, batch_id: int, *inner: str) -> None:
    """Write into the batch's own partition, replacing what an earlier try left there."""
    (df.withColumn("stream_id", F.lit(stream)).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("stream_id", "batch_id", *inner).parquet(path))


def totals(spark: SparkSession, sinks: Sinks, stream: str | None = None) -> DataFrame:
    """Messages received, broken and logged, and the logged amount, per stream (one row per batch is read)."""
    counts = spark.read.schema(COUNTS).parquet(sinks.counts)
    if stream is not None:
        counts = counts.where(F.col("stream_id") == stream)
    return counts.groupBy("stream_id").agg(F.count(F.lit(1)).alias("batches"), F.sum("received").alias("received"),
                                           F.sum("broken").alias("broken"), F.sum("logged").alias("logged"),
                                           F.sum("amount").cast("decimal(38,2)").alias("amount"))


def event_lines(parsed: DataFrame, place: Column) -> DataFrame:
    """One line per message that can be read: its place in the topic, type and first-present amount."""
    amount = first_amount()
    return parsed.where(~F.col("malformed")).select(
        place.alias("place"), F.coalesce(F.col("msg.event_type"), F.lit("unknown")).alias("event_type"),
        amount.cast("double").alias("amount"), F.concat(F.lit("KES "), running_amount_label(amount)).alias("label"))
