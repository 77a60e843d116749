"""Event decoding (strict / lenient / quarantine) and the file-fed stream."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from starling.sources import testbed
from starling.streaming import decode as D
from starling.streaming import ingest
from tests.conftest import SF_SMALL

TS = "2024-01-01T10:00:00.123456+00:00"


def _feed(spark, values):
    return spark.createDataFrame([(str(i), v, i, None) for i, v in enumerate(values)], ingest.FEED_SCHEMA)


MSGS = [
    json.dumps({"event_type": "new_policy", "policy_id": "P1", "customer_name": "Ann", "premium_amount": 1200.5,
                "county": "Nairobi", "timestamp": TS}),
    json.dumps({"event_type": "new_claim", "claim_id": "C1", "policy_id": "P1", "status": "Pending", "timestamp": TS}),
    json.dumps({"event_type": "x", "event_id": 77}),
    "not json",
]


def test_strict_drops_unknown_and_keeps_missing_null(spark):
    out = D.decode(_feed(spark, MSGS), "strict", F.lit(dt.datetime(2024, 1, 2)).cast("timestamp")).collect()
    assert sorted(r["event_type"] for r in out) == ["new_claim", "new_policy"]
    pol = next(r for r in out if r["event_type"] == "new_policy")
    assert pol["event_id"] == "P1" and pol["amount"] == Decimal("1200.50") and pol["extra_info"] == "Nairobi"
    assert pol["event_timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    claim = next(r for r in out if r["event_type"] == "new_claim")
    assert claim["amount"] is None


def test_lenient_keeps_unknown_with_defaults(spark):
    ingest_ts = dt.datetime(2024, 1, 2)
    out = D.decode(_feed(spark, MSGS), "lenient", F.lit(ingest_ts).cast("timestamp")).collect()
    assert len(out) == 3
    unk = next(r for r in out if r["event_type"] == "x")
    assert (unk["event_id"], unk["amount"], unk["extra_info"], unk["policy_id"]) == ("77", Decimal("0.00"), "", "")
    assert unk["event_timestamp"] == ingest_ts
    claim = next(r for r in out if r["event_type"] == "new_claim")
    assert claim["amount"] == Decimal("0.00") and claim["customer_name"] == ""


def test_malformed_is_quarantined(spark):
    q = D.quarantine(_feed(spark, MSGS), keep=["key"]).collect()
    assert [r["raw_value"] for r in q] == ["not json"]


def test_failfast_mode_raises_on_malformed(spark):
    import pytest
    with pytest.raises(Exception):
        D.decode(_feed(spark, MSGS), "strict", failfast=True).collect()
    ok = D.decode(_feed(spark, MSGS[:2]), "strict", failfast=True).count()
    assert ok == 2


def test_event_totals_on_feed(spark):
    feed = testbed.event_feed(spark, SF_SMALL)
    totals = {r["event_type"]: r["events"] for r in D.event_totals(D.decode(feed, "strict")).collect()}
    assert set(totals) == {"new_policy", "new_claim", "new_payment"}
    assert sum(totals.values()) == feed.where(F.col("key").isin(*D.KNOWN_TYPES)).count()


def test_stream_available_now_restart_no_duplicates(spark):
    root = tempfile.mkdtemp(prefix="stream-test-")
    src, sink, ckpt, bad = (os.path.join(root, d) for d in ("in", "log", "ckpt", "bad"))
    feed = testbed.event_feed(spark, SF_SMALL)
    feed.where(F.col("seq") % 2 == 0).write.parquet(os.path.join(src, "part1"))
    _feed(spark, ["not json"]).write.parquet(os.path.join(src, "part0"))

    def run():
        for q in ingest.start_event_log(ingest.file_feed(spark, src + "/*"), sink, ckpt, "strict",
                                        quarantine_path=bad):
            q.awaitTermination(120)

    run()
    first = spark.read.parquet(sink).count()
    run()  # nothing new: the checkpoint makes the restart a no-op
    assert spark.read.parquet(sink).count() == first
    feed.where(F.col("seq") % 2 == 1).write.parquet(os.path.join(src, "part2"))
    run()
    log = spark.read.parquet(sink)
    batch = D.decode(feed, "strict")
    assert log.count() == batch.count()
    # stream and batch decode agree (ingested_at aside)
    cols = ["event_type", "event_id", "policy_id", "amount", "extra_info", "event_timestamp"]
    assert log.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert spark.read.parquet(bad).count() == 1


def test_foreach_batch_sink_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="feb-test-")
    src, table, ckpt = (os.path.join(root, d) for d in ("in", "table", "ckpt"))
    testbed.event_feed(spark, SF_SMALL).write.parquet(os.path.join(src, "p1"))
    q = ingest.start_event_log_foreach_batch(ingest.file_feed(spark, src + "/*"), table, ckpt, "lenient")
    q.awaitTermination(120)
    n = spark.read.parquet(table).count()
    q = ingest.start_event_log_foreach_batch(ingest.file_feed(spark, src + "/*"), table, ckpt, "lenient")
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == n == testbed.event_feed(spark, SF_SMALL).count()
    # a replayed micro-batch (same id, e.g. after a crash before the commit) replaces its own output
    replay = (ingest.decode(testbed.event_feed(spark, SF_SMALL), "lenient")
              .withColumn("stream_id", F.lit(ingest.stream_id(spark, ckpt)))
              .withColumn("batch_id", F.lit(0).cast("long")))
    (replay.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("stream_id", "batch_id").parquet(table))
    assert spark.read.parquet(table).count() == n
    # another feed under a new checkpoint starts at batch 0 again and erases nothing
    other = os.path.join(root, "other")
    _feed(spark, MSGS[:3]).write.parquet(os.path.join(other, "p1"))
    q = ingest.start_event_log_foreach_batch(ingest.file_feed(spark, other + "/*"), table, os.path.join(root, "c2"),
                                             "lenient")
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == n + 3


def test_broken_feed_is_quarantined(spark):
    got = D.quarantine(testbed.broken_feed(spark, SF_SMALL), keep=["seq"]).collect()
    ids = [r["seq"] for r in got]
    want = [r[0] for r in testbed.event_feed(spark, SF_SMALL).where("seq % 97 < 2").select("seq").collect()]
    assert ids and sorted(ids) == sorted(want)
