"""Decode the event topic into event-log rows.

One decoder, two explicit policies (the two consumers disagree):

* ``strict``  (log A): unknown event types are dropped, absent fields are
  null, amount DECIMAL(15,2); offsets start at ``earliest``.
* ``lenient`` (log B): unknown types are kept (amount 0, extra ""), absent
  fields default to "" / 0 / the ingest time, adds ``customer_name``;
  offsets start at ``latest``.  Note: an explicit JSON null also gets the
  default (``coalesce``), where the original only defaulted absent keys.

Malformed messages (not a JSON object) are quarantined instead of stopping
the consumer.  Works on batch and streaming frames alike (pure projection,
no state), on any frame with a string/binary ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.schemas import EVENT_LOG_LENIENT, EVENT_LOG_STRICT, EVENT_MESSAGE, EVENT_MONEY, conform

KNOWN_TYPES = ["new_policy", "new_claim", "new_payment"]
# per event type: (id field, amount field, extra-info field)
FIELDS_BY_TYPE = {
    "new_policy": ("policy_id", "premium_amount", "county"),
    "new_claim": ("claim_id", "claim_amount", "status"),
    "new_payment": ("payment_id", "amount_paid", "payment_method"),
}
_CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(EVENT_MESSAGE.fields + [T.StructField(_CORRUPT, T.StringType(), True)])


def parse(df: DataFrame, failfast: bool = False) -> DataFrame:
    """Add ``msg`` (parsed struct) and ``malformed`` (value is not a JSON object).

    ``failfast=True`` makes a malformed message fail the batch instead (the
    original consumers stopped on one); the default quarantines it.
    """
    v = F.col("value").cast("string")
    opts = {"mode": "FAILFAST"} if failfast else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    msg = F.from_json(v, _PARSE_SCHEMA, opts)
    # Parse once: a generator output is a barrier for predicate pushdown, so the
    # filters downstream (malformed, known types) cannot re-inline from_json below it.
    out = df.withColumn("msg", F.explode(F.array(msg)))
    return out.withColumn("malformed", v.isNull() | F.col("msg").isNull() | F.col(f"msg.{_CORRUPT}").isNotNull())


def _by_type(etype: Column, slot: int, default: Column | None) -> Column:
    expr = None
    for t, names in FIELDS_BY_TYPE.items():
        val = F.col(f"msg.{names[slot]}")
        if default is not None:
            val = F.coalesce(val, default)
        expr = F.when(etype == t, val) if expr is None else expr.when(etype == t, val)
    return expr


def decode_strict(parsed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    ingest_ts = ingest_ts if ingest_ts is not None else F.current_timestamp()
    ok = parsed.where(~F.col("malformed"))
    etype = F.col("msg.event_type")
    ok = ok.where(etype.isin(*KNOWN_TYPES))
    out = ok.select(
        etype.alias("event_type"), _by_type(etype, 0, None).alias("event_id"),
        F.col("msg.policy_id").alias("policy_id"), _by_type(etype, 1, None).alias("amount"),
        _by_type(etype, 2, None).alias("extra_info"), F.col("msg.timestamp").alias("event_timestamp"),
        ingest_ts.alias("ingested_at"))
    return conform(out, EVENT_LOG_STRICT)


def decode_lenient(parsed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    ingest_ts = ingest_ts if ingest_ts is not None else F.current_timestamp()
    ok = parsed.where(~F.col("malformed"))
    etype = F.coalesce(F.col("msg.event_type"), F.lit("unknown"))
    empty, zero = F.lit(""), F.lit(0).cast(EVENT_MONEY)
    known = etype.isin(*KNOWN_TYPES)
    out = ok.select(
        etype.alias("event_type"),
        F.when(known, _by_type(etype, 0, empty)).otherwise(F.coalesce(F.col("msg.event_id"), empty)).alias("event_id"),
        F.coalesce(F.col("msg.policy_id"), empty).alias("policy_id"),
        F.coalesce(F.col("msg.customer_name"), empty).alias("customer_name"),
        F.when(known, _by_type(etype, 1, zero)).otherwise(zero).alias("amount"),
        F.when(known, _by_type(etype, 2, empty)).otherwise(empty).alias("extra_info"),
        F.coalesce(F.col("msg.timestamp"), ingest_ts).alias("event_timestamp"),
        ingest_ts.alias("ingested_at"))
    return conform(out, EVENT_LOG_LENIENT)


def decode(df: DataFrame, policy: str = "strict", ingest_ts: Column | None = None,
           failfast: bool = False) -> DataFrame:
    return decode_parsed(parse(df, failfast), policy, ingest_ts)


def decode_parsed(parsed: DataFrame, policy: str, ingest_ts: Column | None = None) -> DataFrame:
    """Event-log rows of messages that ``parse`` has read."""
    if policy == "strict":
        return decode_strict(parsed, ingest_ts)
    if policy == "lenient":
        return decode_lenient(parsed, ingest_ts)
    raise ValueError(f"unknown decode policy {policy!r}")


def quarantine(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Messages that are not JSON objects, with their raw value (for replay after a fix)."""
    parsed = parse(df)
    cols = keep or [c for c in df.columns if c != "value"]
    return parsed.where(F.col("malformed")).select(*cols, F.col("value").cast("string").alias("raw_value"))


def event_totals(log: DataFrame) -> DataFrame:
    """Q-22: events and total value per event type over an event log."""
    return log.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                         F.sum("amount").cast("double").alias("total_value"))


def running_amount_label(amount: Column) -> Column:
    """'1,234.56' console label for an event amount (first present amount field, default 0)."""
    return F.format_number(F.coalesce(amount, F.lit(0)).cast("double"), 2)


def first_amount(msg_prefix: str = "msg") -> Column:
    """premium_amount, else claim_amount, else amount_paid, else 0."""
    return F.coalesce(F.col(f"{msg_prefix}.premium_amount"), F.col(f"{msg_prefix}.claim_amount"),
                      F.col(f"{msg_prefix}.amount_paid"), F.lit(0).cast(EVENT_MONEY))
