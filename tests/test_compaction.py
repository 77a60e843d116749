"""Compaction of the event log: every row once, at any moment; counts checked; old folders expire."""

import os
import tempfile

import pytest

from starling.sources.files import list_folders, remove_path
from starling.streaming import compaction as K
from starling.streaming import consumer as C
from tests.test_consumer import SCHEMA, message


@pytest.fixture()
def sinks(spark):
    root = tempfile.mkdtemp(prefix="compaction-test-")
    return C.Sinks(os.path.join(root, "log"), os.path.join(root, "log-counts"))


def batch(spark, sinks, n, stream="s1", policy=C.STRICT, size=10):
    ids = range(n * size, n * size + size)
    rows = spark.createDataFrame([(f"k{i}".encode(), message(i), i) for i in ids], SCHEMA).repartition(2)
    C.write_batch(C.messages(rows), n, stream, sinks, policy)


def ids(spark, sinks, policy=C.STRICT):
    return sorted((r["stream_id"], r["batch_id"], r["event_id"]) for r in K.read_log(spark, sinks, policy).collect())


def files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_compacted_log_holds_every_row_once(spark, sinks):
    assert K.compact(spark, sinks, "s1", C.STRICT) is None           # no batch yet
    assert ids(spark, sinks) == []
    for n in range(4):
        batch(spark, sinks, n)
        batch(spark, sinks, n, "s2")
    before = ids(spark, sinks)
    assert len(before) == 48
    assert K.compact(spark, sinks, "s1", C.STRICT) == 18             # batches 0 to 2; 3 may be repeated
    assert files(sinks.log + "-segments/rows") == 1 and ids(spark, sinks) == before
    assert K.compact(spark, sinks, "s1", C.STRICT) is None
    batch(spark, sinks, 3)                                           # the newest batch is repeated
    assert ids(spark, sinks) == before
    for n in (4, 5):
        batch(spark, sinks, n)
    more = ids(spark, sinks)
    assert len(more) == 60
    assert K.compact(spark, sinks, "s1", C.STRICT) == 12             # 3 and 4 only
    assert ids(spark, sinks) == more
    found = [(r["first"], r["upto"], r["row_count"]) for r in K.segments(spark, sinks).orderBy("first").collect()]
    assert found == [(0, 2, 18), (3, 4, 12)]


def test_a_compaction_that_broke_off_is_not_seen_and_replaced(spark, sinks, monkeypatch):
    for n in range(3):
        batch(spark, sinks, n)
    before = ids(spark, sinks)
    K.compact(spark, sinks, "s1", C.STRICT)
    remove_path(spark, f"{sinks.log}-segments/manifest/stream_id=s1")     # as if it had ended before its manifest
    assert ids(spark, sinks) == before
    batch(spark, sinks, 3)
    assert K.compact(spark, sinks, "s1", C.STRICT) == 18
    assert len(ids(spark, sinks)) == 24 and list_folders(spark, sinks.log + "-segments/rows") == ["segment=s1-0"]


def test_rows_that_the_consumer_did_not_count_stop_a_compaction(spark, sinks):
    for n in range(3):
        batch(spark, sinks, n)
    remove_path(spark, f"{sinks.log}/stream_id=s1/batch_id=1")
    with pytest.raises(K.CountMismatch, match="12 rows counted, 6 in the log"):
        K.compact(spark, sinks, "s1", C.STRICT)
    assert K.segments(spark, sinks).isEmpty() and len(ids(spark, sinks)) == 12
    with pytest.raises(ValueError):
        K.compact(spark, sinks, "s1", C.STRICT, keep=0)


def test_merged_folders_expire_one_compaction_later(spark, sinks):
    for n in range(3):
        batch(spark, sinks, n, policy=C.LENIENT)
    K.compact(spark, sinks, "s1", C.LENIENT)
    assert K.expire(spark, sinks, "s1") == 0                         # readers may still be at them
    for n in (3, 4):
        batch(spark, sinks, n, policy=C.LENIENT)
    before = ids(spark, sinks, C.LENIENT)
    K.compact(spark, sinks, "s1", C.LENIENT)
    assert K.expire(spark, sinks, "s1") == 2 and K.expire(spark, sinks, "s1") == 0
    assert list_folders(spark, f"{sinks.log}/stream_id=s1") == ["batch_id=2", "batch_id=3", "batch_id=4"]
    assert ids(spark, sinks, C.LENIENT) == before and len(before) == 40


def test_batches_without_rows(spark, sinks):
    empty = spark.createDataFrame([], SCHEMA)
    for n in range(2):
        C.write_batch(C.messages(empty), n, "s1", sinks, C.STRICT)
    assert K.compact(spark, sinks, "s1", C.STRICT) == 0 and ids(spark, sinks) == []
    batch(spark, sinks, 2)
    assert len(ids(spark, sinks)) == 6


def test_reading_prunes_folders(spark, sinks):
    for n in range(3):
        batch(spark, sinks, n)
    K.compact(spark, sinks, "s1", C.STRICT)
    plan = K.read_log(spark, sinks, C.STRICT)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert len(filters) == 2 and any("batch_id" in f.split("PartitionFilters")[1] for f in filters)
    assert any("segment" in f.split("PartitionFilters")[1] for f in filters)


def test_every_stream_is_compacted(spark, sinks):
    for n in range(2):
        batch(spark, sinks, n, "s1")
        batch(spark, sinks, n, "s2")
    before = ids(spark, sinks)
    assert K.compact_all(spark, sinks, C.STRICT) == {s: {"merged": 6, "expired": 0} for s in ("s1", "s2")}
    assert ids(spark, sinks) == before
