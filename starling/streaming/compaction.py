"""Compaction of a consumer's event log: the folders of many micro-batches become few files per day.

The consumer writes each micro-batch into a folder of its own, so that a repeated batch can
replace it.  Once the next batch has begun a batch is never repeated, and its folder can be
merged.  Layout, beside the log:

    {log}-segments/rows/segment={stream id}-{first batch}/ingest_date={day}/*.parquet
    {log}-segments/manifest/stream_id={stream id}/upto={last batch}/*.json

``compact`` merges the batches since the last compaction into one segment, compares its rows
with the consumer's own counts, and writes the manifest last.  Readers (``read_log``) take the
segments that have a manifest, and of the log the batches beyond them; both are partition
filters.  So a compaction that broke off is not seen, and the next one replaces what it left.
``expire`` then deletes the folders of merged batches, but for those of the newest segments,
which readers that began before the compaction may still read.

One compaction at a time per stream; the consumer may go on meanwhile.  The manifest has a row
per compaction.  A stream without complete batches, or without new ones, gives no segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.schemas import EVENT_LOG_LENIENT, EVENT_LOG_STRICT
from starling.sources.files import list_folders, read_or_empty, remove_path
from starling.streaming.consumer import COUNTS, ConsumerPolicy, Sinks

MANIFEST = T.StructType([T.StructField("first", T.LongType()), T.StructField("row_count", T.LongType()),
                         T.StructField("segment", T.StringType()), T.StructField("stream_id", T.StringType()),
                         T.StructField("upto", T.LongType())])
EVENT_LOGS = {"strict": EVENT_LOG_STRICT, "lenient": EVENT_LOG_LENIENT}


class CountMismatch(RuntimeError):
    """The log does not hold the rows that its consumer counted."""


def log_schema(policy: ConsumerPolicy) -> T.StructType:
    return T.StructType([*EVENT_LOGS[policy.decode].fields, T.StructField("stream_id", T.StringType()),
                         T.StructField("batch_id", T.LongType()), T.StructField("ingest_date", T.DateType())])


def _folder(sinks: Sinks, part: str) -> str:
    return f"{sinks.log.rstrip('/')}-segments/{part}"


def segments(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """One row per compaction that was completed."""
    path = _folder(sinks, "manifest")
    if not list_folders(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path)


def compact(spark: SparkSession, sinks: Sinks, stream: str, policy: ConsumerPolicy, keep: int = 1) -> int | None:
    """Merge a stream's complete batches, but the ``keep`` newest, into a segment.

    Returns its rows, or None where there is nothing to merge.  ``keep`` is 1 at least: the
    newest batch may be repeated as long as its successor has not begun.
    """
    if keep < 1:
        raise ValueError("keep: 1 or more, the newest batch may be repeated")
    own = F.col("stream_id") == stream
    counts = read_or_empty(spark, sinks.counts, COUNTS).where(own)
    newest = counts.agg(F.max("batch_id")).first()[0]
    before = segments(spark, sinks).where(own).agg(F.max("upto")).first()[0]
    first = 0 if before is None else before + 1
    if newest is None or newest - keep < first:
        return None
    upto = newest - keep
    due = own & F.col("batch_id").between(first, upto)
    counted = counts.where(due).agg(F.sum("logged")).first()[0] or 0
    segment, schema = f"{stream}-{first}", log_schema(policy)
    path = _folder(sinks, f"rows/segment={segment}")
    rows = read_or_empty(spark, sinks.log, schema).where(due)
    # one directory per day in each task, small days together, a hot day over several files
    rows.hint("rebalance", "ingest_date").write.mode("overwrite").partitionBy("ingest_date").parquet(path)
    written = spark.read.schema(schema).parquet(path).count()      # from file footers
    if written != counted:
        remove_path(spark, path)
        raise CountMismatch(f"batches {first} to {upto} of stream {stream}: {counted} rows counted, {written} in the log")
    manifest = spark.createDataFrame([(first, written, segment)], T.StructType(MANIFEST.fields[:3]))
    manifest.coalesce(1).write.mode("overwrite").json(_folder(sinks, f"manifest/stream_id={stream}/upto={upto}"))
    return written


def read_log(spark: SparkSession, sinks: Sinks, policy: ConsumerPolicy) -> DataFrame:
    """Every row of the log once, from segments and from batches that no segment holds."""
    schema = log_schema(policy)
    done = segments(spark, sinks).select("segment", "stream_id", "upto").collect()      # one row per compaction
    raw = read_or_empty(spark, sinks.log, schema)
    if not done:
        return raw
    upto: dict[str, int] = {}
    for row in done:
        upto[row["stream_id"]] = max(row["upto"], upto.get(row["stream_id"], -1))
    for stream, last in upto.items():
        raw = raw.where((F.col("stream_id") != stream) | (F.col("batch_id") > last))
    merged = (spark.read.schema(T.StructType([*schema.fields, T.StructField("segment", T.StringType())]))
              .parquet(_folder(sinks, "rows")).where(F.col("segment").isin([r["segment"] for r in done])))
    return merged.select(*schema.names).unionAll(raw.select(*schema.names))


def expire(spark: SparkSession, sinks: Sinks, stream: str, grace: int = 1) -> int:
    """Delete the log's folders of batches that segments hold, but for those of the ``grace`` newest segments."""
    done = sorted(r["upto"] for r in segments(spark, sinks).where(F.col("stream_id") == stream).collect())
    done = done[:len(done) - grace] if grace else done
    if not done:
        return 0
    root, gone = f"{sinks.log.rstrip('/')}/stream_id={stream}", 0
    for name in list_folders(spark, root):
        if name.startswith("batch_id=") and int(name.partition("=")[2]) <= done[-1]:
            remove_path(spark, f"{root}/{name}")
            gone += 1
    return gone


def compact_all(spark: SparkSession, sinks: Sinks, policy: ConsumerPolicy, keep: int = 1, grace: int = 1) -> dict[str, dict]:
    """Compact and expire every stream of a log: rows merged and folders deleted by stream id."""
    names = [n.partition("=")[2] for n in list_folders(spark, sinks.counts) if n.startswith("stream_id=")]
    return {s: {"merged": compact(spark, sinks, s, policy, keep), "expired": expire(spark, sinks, s, grace)} for s in names}
