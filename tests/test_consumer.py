"""The topic consumer: both policies, limits per micro-batch, counts, replays."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from starling.streaming import consumer as C
from starling.streaming import decode as D

SCHEMA = "key binary, value string, seq long"


def message(i):
    kind = i % 5
    if kind == 3:
        return "broken"
    if kind == 4:
        return json.dumps({"event_type": "other", "event_id": i})
    return json.dumps({"event_type": "new_payment", "payment_id": f"PAY-{i}", "policy_id": f"P{i % 3}", "amount_paid": i})


def put(spark, folder, ids, name):
    rows = [(f"k{i}".encode(), message(i), i) for i in ids]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


class Setting:
    def __init__(self, spark, policy):
        self.spark, self.policy, root = spark, policy, tempfile.mkdtemp(prefix="consumer-test-")
        self.folder, self.checkpoint = os.path.join(root, "in"), os.path.join(root, "ckpt")
        self.sinks = C.Sinks(os.path.join(root, "log"), os.path.join(root, "counts"), os.path.join(root, "bad"))

    def run(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        topic = C.folder_topic(self.spark, self.policy, self.folder + "/*", self.checkpoint, schema)
        q = C.start(topic, self.sinks, self.checkpoint, self.policy)
        q.awaitTermination(300)
        if q.exception():
            raise q.exception()
        return [p.numInputRows for p in q.recentProgress if p.numInputRows]

    def totals(self):
        return [tuple(r)[1:5] for r in C.totals(self.spark, self.sinks).collect()]

    def log(self):
        return self.spark.read.parquet(self.sinks.log)


def test_strict_consumer_reads_from_the_earliest_on(spark):
    s = Setting(spark, C.STRICT)
    put(spark, s.folder, range(20), "a")
    s.run()
    assert s.totals() == [(1, 20, 4, 12)]
    assert sorted(r["event_id"] for r in s.log().collect()) == sorted(f"PAY-{i}" for i in range(20) if i % 5 < 3)
    assert s.log().select(F.sum("amount")).first()[0] == sum(i for i in range(20) if i % 5 < 3)
    bad = {r["key"]: r["raw_value"] for r in spark.read.parquet(s.sinks.quarantine).collect()}
    assert bad == {f"k{i}": "broken" for i in (3, 8, 13, 18)}      # binary keys come out as text
    s.run()                                                        # nothing new
    assert s.totals() == [(1, 20, 4, 12)]
    put(spark, s.folder, range(20, 30), "b")
    s.run()
    assert s.totals() == [(2, 30, 6, 18)] and s.log().count() == 18


def test_lenient_consumer_starts_at_the_latest(spark):
    s = Setting(spark, C.LENIENT)
    put(spark, s.folder, range(20), "a")
    s.run()
    assert s.totals() in ([], [(1, 0, 0, 0)])
    time.sleep(1.1)
    put(spark, s.folder, range(20, 30), "b")
    s.run()
    assert [t[1:] for t in s.totals()] == [(10, 2, 8)]
    kept = s.log().collect()
    assert {r["event_id"] for r in kept if r["event_type"] == "other"} == {"24", "29"} and len(kept) == 8
    s.run()                                                        # the first start is remembered
    assert s.log().count() == 8


def test_limits_bound_every_micro_batch(spark):
    s = Setting(spark, C.STRICT.with_limits(files=1))
    for n, first in enumerate(range(0, 24, 10)):
        put(spark, s.folder, range(first, min(first + 10, 24)), f"f{n}")
        time.sleep(0.05)
    assert s.run() == [10, 10, 4]                                  # the last batch is a partial one
    assert s.totals() == [(3, 24, 5, 15)]


def test_counts_are_exact_beyond_the_progress_that_spark_keeps(spark):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        s = Setting(spark, C.STRICT.with_limits(files=1))
        for i in range(8):
            put(spark, s.folder, range(i * 5, i * 5 + 5), f"f{i}")
        assert len(s.run()) <= 3                                   # 8 batches ran
        assert s.totals() == [(8, 40, 8, 24)]
        put(spark, s.folder, range(40, 50), "more")
        s.run()
        assert s.totals() == [(9, 50, 10, 30)] and s.log().count() == 30
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_repeated_batch_replaces_what_it_wrote(spark):
    s = Setting(spark, C.STRICT)
    rows = spark.createDataFrame([(f"k{i}".encode(), message(i), i) for i in range(20)], SCHEMA)
    parsed = C.messages(rows)
    for _ in range(2):
        counts = C.write_batch(parsed, 0, "one", s.sinks, s.policy)
    assert (counts["received"], counts["broken"], counts["logged"]) == (20, 4, 12)
    C.write_batch(parsed, 0, "two", s.sinks, s.policy)
    assert sorted(s.totals()) == [(1, 20, 4, 12)] * 2 and s.log().count() == 24
    assert C.totals(spark, s.sinks, "one").count() == 1


def test_a_failed_batch_is_tried_again_after_a_restart(spark, monkeypatch):
    s = Setting(spark, C.STRICT)
    put(spark, s.folder, range(10), "a")
    whole = C.write_batch

    def failing(batch, batch_id, stream, sinks, policy):
        whole(batch, batch_id, stream, sinks, policy)
        raise OSError("sink is down")

    monkeypatch.setattr(C, "write_batch", failing)
    with pytest.raises(Exception, match="sink is down"):
        s.run()
    monkeypatch.setattr(C, "write_batch", whole)
    first = {r["ingested_at"] for r in s.log().collect()}
    s.run()
    assert s.totals() == [(1, 10, 2, 6)] and s.log().count() == 6
    assert {r["ingested_at"] for r in s.log().collect()} == first     # the batch's time is part of the checkpoint


def test_policies_choose_the_reader_options():
    assert C.STRICT.kafka_options() == {"startingOffsets": "earliest", "failOnDataLoss": "true"}
    mirror = C.LENIENT.with_limits(rows=C.MIRROR_ROWS)
    assert mirror.kafka_options() == {"startingOffsets": "latest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10"}
    assert C.STRICT.folder_options() == {}
    assert C.STRICT.with_limits(files=3).folder_options() == {"maxFilesPerTrigger": "3"}
    assert C.STRICT.with_limits(max_bytes="1g").folder_options() == {"maxBytesPerTrigger": "1g"}
    with pytest.raises(ValueError):
        C.STRICT.with_limits(files=3, max_bytes="1g").folder_options()


def test_event_lines_show_the_first_present_amount(spark):
    rows = [(json.dumps({"event_type": "x", "claim_amount": 5, "amount_paid": 7}), 1), (json.dumps({"amount_paid": 1234.5}), 2),
            (json.dumps({"event_type": "y", "premium_amount": 9, "claim_amount": 5}), 3), ("broken", 4), (json.dumps({}), 5)]
    lines = C.event_lines(D.parse(spark.createDataFrame(rows, "value string, seq long")), F.col("seq")).collect()
    assert [(r["place"], r["event_type"], r["label"]) for r in sorted(lines)] == [
        (1, "x", "KES 5.00"), (2, "unknown", "KES 1,234.50"), (3, "y", "KES 9.00"), (5, "unknown", "KES 0.00")]
