"""Domain tables derived from the driver's TPC-H-style test tables.

| domain     | from                 |
|------------|----------------------|
| customers  | customer + nation    |
| policies   | orders               |
| agents     | supplier + nation    |
| claims     | lineitem + orders    |
| region map | nation + region      |
| event feed | events (JSON messages, key = event type) |

Everything is a lazy projection/join of the scans, so the work grows with the
tables and Catalyst prunes unused columns down to the Parquet readers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.hashing import pick
from starling.params import RunParams
from starling.schemas import EVENT_MONEY, MONEY
from starling.sources.files import read_parquet, table_path

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# ---- fixed mapping values --------------------------------------------------
SIGNUP_EPOCH = _dt.date(1995, 1, 1)
HIRE_EPOCH = _dt.date(1990, 1, 1)
POLICY_TERM_DAYS = 365 * 5
ORDER_STATUS_TO_POLICY = {"O": "Active", "F": "Expired", "P": "Pending"}
CLAIM_TYPES = ["Medical", "Accident", "Theft", "Fire", "Death"]
# (l_returnflag, l_linestatus) -> claim status; "Under Review" is unknown to dim_claim_status
CLAIM_STATUS_BY_FLAGS = {("R", "F"): "Approved", ("R", "O"): "Pending", ("A", "F"): "Paid",
                         ("A", "O"): "Rejected", ("N", "F"): "Escalated", ("N", "O"): "Under Review"}
APPROVED_STATUSES = ["Approved", "Paid"]
# stream producer value lists
STREAM_POLICY_TYPES = ["Auto", "Home", "Life", "Health", "Business"]
STREAM_CLAIM_STATUSES = ["Pending", "Approved", "Rejected", "Under Review"]
STREAM_PAYMENT_METHODS = ["M-Pesa", "Bank Transfer", "Credit Card", "Cash"]
STREAM_COUNTIES = ["Nairobi", "Mombasa", "Kisumu", "Nakuru", "Eldoret",
                   "Thika", "Malindi", "Kitale", "Garissa", "Nyeri"]
EVENT_TYPE_BY_SOURCE = {"signup": "new_policy", "error": "new_claim", "purchase": "new_payment"}
# ---------------------------------------------------------------------------


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, table_path(sf_dir, name))


def customers(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    n = read_driver(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        (F.lit(18) + F.pmod(key, F.lit(63))).cast("int").alias("age"),
        F.when(F.pmod(key, F.lit(2)) == 0, "Male").otherwise("Female").alias("gender"),
        F.col("n_name").alias("county"),
        F.date_add(F.lit(SIGNUP_EPOCH), F.pmod(key * 37, F.lit(2400)).cast("int")).alias("signup_date"),
        F.lit(params.load_ts).cast("timestamp").alias("ingested_at"),
    )


def _policy_status(col):
    expr = None
    for k, v in ORDER_STATUS_TO_POLICY.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def policies(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("policy_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("policy_type"),
        F.col("o_totalprice").cast(MONEY).alias("premium"),
        start.alias("start_date"),
        F.date_add(start, POLICY_TERM_DAYS).alias("end_date"),
        _policy_status(F.col("o_orderstatus")).alias("status"),
    )


def agents(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier")
    n = read_driver(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        key.cast("string").alias("agent_id"),
        F.col("s_name").alias("full_name"),
        F.format_string("07%08d", F.pmod(key, F.lit(100_000_000))).alias("phone"),
        F.concat(F.lit("agent"), key.cast("string"), F.lit("@agents.example")).alias("email"),
        F.col("n_name").alias("county"),
        F.date_add(F.lit(HIRE_EPOCH), F.pmod(key * 53, F.lit(3650)).cast("int")).alias("hire_date"),
        F.when(F.col("s_acctbal") >= 0, "Active").otherwise("Inactive").alias("status"),
    )


def _claim_status(flag, status):
    expr = None
    for (f, s), v in CLAIM_STATUS_BY_FLAGS.items():
        cond = (flag == f) & (status == s)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def claims(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    amount = F.col("l_extendedprice").cast(MONEY)
    status = _claim_status(F.col("l_returnflag"), F.col("l_linestatus"))
    keep = F.lit(1).cast("decimal(3,0)") - F.col("l_discount").cast("decimal(4,2)")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("claim_id"),
        F.col("l_orderkey").cast("string").alias("policy_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        pick(CLAIM_TYPES, F.col("l_partkey")).alias("claim_type"),
        amount.alias("claim_amount"),
        status.alias("claim_status"),
        F.to_date("o_orderdate").alias("incident_date"),
        F.to_date("l_shipdate").alias("claim_date"),
        F.when(status.isin(*APPROVED_STATUSES), F.round(amount * keep, 2)).otherwise(F.lit(0))
         .cast(MONEY).alias("approved_amount"),
        F.lit(params.load_ts).cast("timestamp").alias("created_at"),
    )


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """county -> region via the real nation/region tables (bounded: one row per nation)."""
    n = read_driver(spark, sf_dir, "nation")
    r = read_driver(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_name").alias("county"), F.col("r_name").alias("region"))


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message topic: (key, value, seq, ts) with flat JSON values per event type."""
    e = read_driver(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    day = F.to_date("ts").cast("string")
    amount = F.col("value").cast(EVENT_MONEY)
    holder = F.concat(F.lit("POL-"), F.col("user_id").cast("string"))
    policy = F.struct(F.lit("new_policy").alias("event_type"), holder.alias("policy_id"),
                      F.concat(F.lit("Customer "), F.col("user_id").cast("string")).alias("customer_name"),
                      pick(STREAM_POLICY_TYPES, k).alias("policy_type"), amount.alias("premium_amount"),
                      pick(STREAM_COUNTIES, k).alias("county"), day.alias("start_date"), iso.alias("timestamp"))
    claim = F.struct(F.lit("new_claim").alias("event_type"),
                     F.concat(F.lit("CLM-"), F.col("event_id").cast("string")).alias("claim_id"),
                     holder.alias("policy_id"), amount.alias("claim_amount"),
                     pick(STREAM_CLAIM_STATUSES, k).alias("status"), day.alias("incident_date"),
                     iso.alias("timestamp"))
    payment = F.struct(F.lit("new_payment").alias("event_type"),
                       F.concat(F.lit("PAY-"), F.col("event_id").cast("string")).alias("payment_id"),
                       holder.alias("policy_id"), amount.alias("amount_paid"),
                       pick(STREAM_PAYMENT_METHODS, k).alias("payment_method"), day.alias("payment_date"),
                       iso.alias("timestamp"))
    other = F.struct(F.col("event_type"), F.col("event_id"), iso.alias("timestamp"))
    t = F.col("event_type")
    value = (F.when(t == "signup", F.to_json(policy)).when(t == "error", F.to_json(claim))
             .when(t == "purchase", F.to_json(payment)).otherwise(F.to_json(other)))
    key = (F.when(t == "signup", "new_policy").when(t == "error", "new_claim")
           .when(t == "purchase", "new_payment").otherwise(t))
    return e.select(key.alias("key"), value.alias("value"), F.col("event_id").alias("seq"), "ts")


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic with messages broken by a rule on the event id: cut-off JSON and plain text."""
    seq = F.col("seq")
    value = (F.when(seq % 97 == 0, F.concat(F.lit('{"event_type": "'), F.col("key")))
             .when(seq % 97 == 1, F.concat(F.lit("broken message "), seq.cast("string"))).otherwise(F.col("value")))
    return event_feed(spark, sf_dir).withColumn("value", value)


def domain(spark: SparkSession, sf_dir: str, params: RunParams) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir, params),
        "policies": policies(spark, sf_dir, params),
        "agents": agents(spark, sf_dir, params),
        "claims": claims(spark, sf_dir, params),
        "region_map": region_map(spark, sf_dir),
    }
